"""DataFrame -> DataFrame operators of the silver and gold layers."""
