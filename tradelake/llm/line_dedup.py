"""Near-duplicate lines: segment-partition edit join.

Texts are split at line ends; lines of fewer than ``min_chars`` characters take
no part, or, with ``every_line``, all but empty lines do and the bound follows
the length below it: ``max_edits`` times the shorter line's share of
``min_chars``, rounded down.  Equal lines are collapsed first, so however often a line occurs it is
one row of the join.  A line is cut into ``max_edits + 1`` even segments; a line
within ``max_edits`` edits must hold one of them unchanged, near its place.  So
segments are indexed by (length, number, hash) and every line probes the
indexes of its own and the next shorter lengths with the substrings that can be
that segment.  Lines that meet are verified by a banded bit-parallel edit
distance over the part that is left without their common beginning.

Index entries that more than ``hot`` lines share (a common template, say) do not
emit their pairs: the join itself compares letter histograms, which differ by
two for an edit at most, and only lets through what can be near.  Where more
than ``crowded`` lines share an entry, their lines are cut once more, into
``max_edits + 2`` segments of which two must be unchanged, and meet on pairs of
segments.

Only DataFrame and SQL functions are used.  Defined results: a null text has no
lines, an empty one has one empty line; repeated rows have lines of their own;
ties between equal lines go to the smallest (doc_id, line number), null ids
last; other columns are ignored or kept as they are.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import clear_name, settled, stored
from tradelake.llm.components import connected_components


def segment_bounds(length: Column, segments: int, i: Column) -> tuple[Column, Column]:
    """1-based start and size of segment ``i`` (0-based) of an even partition;
    the last segments take the remainder."""
    base = F.floor(length / segments).cast("int")
    before = F.greatest(F.lit(0), i - segments + F.pmod(length, F.lit(segments)))
    size = base + F.when(i >= F.lit(segments) - F.pmod(length, F.lit(segments)), 1).otherwise(0)
    return (base * i + before + 1).cast("int"), size.cast("int")


def one_place(max_edits: int, probe: bool) -> list[tuple]:
    """(shorter, segment, shift): how far from its place segment ``i`` of a line
    that is ``shorter`` characters shorter can stand.  One edit at least lies in
    each of the other segments, so no more than ``i`` edits moved it and no
    more than the rest follow it."""
    out = []
    for shorter in range(max_edits + 1 if probe else 1):
        for i in range(max_edits + 1):
            left, right = (i, max_edits - i) if probe else (0, 0)
            out += [(shorter, i, s) for s in range(max(-left, shorter - right), min(left, shorter + right) + 1)]
    return out


def two_places(max_edits: int, probe: bool) -> list[tuple]:
    """(shorter, segment, shift, segment, shift) for two unchanged segments: the
    edits before, between and after them are at least as many as the places
    differ, and ``max_edits`` in all."""
    reach = range(-max_edits, max_edits + 1) if probe else (0,)
    return [(shorter, i, s, j, t) for shorter in range(max_edits + 1 if probe else 1)
            for i, j in combinations(range(max_edits + 2), 2) for s in reach for t in reach
            if abs(s) + abs(t - s) + abs(shorter - t) <= max_edits]


def with_keys(lines: DataFrame, segments: int, places: list[tuple], name: str) -> DataFrame:
    """Lines (id, line, len) -> (``name``, key): the hash of what stands at each place."""
    fields = ("shorter", "i", "s", "j", "t")[: len(places[0])]
    spec = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, p)]) for p in places])
    each = lines.select("id", "line", "len", F.explode(spec).alias("p"))
    length, parts = F.col("len") - F.col("p.shorter"), []
    for seg, shift in zip(fields[1::2], fields[2::2]):
        at, size = segment_bounds(length, segments, F.col(f"p.{seg}"))
        parts += [F.col(f"p.{seg}"), F.substring(F.col("line"), at + F.col(f"p.{shift}"), size)]
    return each.select(F.col("id").alias(name), F.xxhash64(length, *parts).alias("key"))


def common_beginning(a: str, b: str, most: str, steps: int = 20) -> str:
    """SQL: the number of first characters in common, at most ``most``, by bisection."""
    return (f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', {most}), (r, i) -> if(r.lo >= r.hi, r, "
            f"if(substring({a}, r.lo + 1, div_up(r.lo, r.hi) - r.lo) = substring({b}, r.lo + 1, div_up(r.lo, r.hi) - r.lo), "
            "named_struct('lo', div_up(r.lo, r.hi), 'hi', r.hi), "
            "named_struct('lo', r.lo, 'hi', div_up(r.lo, r.hi) - 1))), r -> r.lo)"
            ).replace("div_up(r.lo, r.hi)", "cast(shiftright(r.lo + r.hi + 1, 1) as int)")


def edit_distance(a: str, b: str, max_edits: int) -> str:
    """SQL: the edit distance of two columns that is at most ``max_edits``, a
    larger number where it is more.

    Column by column of the distance matrix, a word of 2 * max_edits + 1 bits
    holds the vertical differences of the cells around the diagonal, and moves
    down by one row with each column.  The cell that counts stays on one bit:
    it starts at the difference of the lengths and grows by one wherever its
    diagonal step is no match."""
    e, width, block = max_edits, 2 * max_edits + 1, 64
    full = (1 << width) - 1
    cell = f"(length({a}) - length({b}) + {e})"
    start = (f"named_struct('p', {full & ~((1 << e) - 1)}, 'n', {(1 << e) - 1}, "
             f"'d', 0, 's', abs(length({a}) - length({b})))")
    equal = " + ".join(f"if(substring(z.x, j + {k}, 1) = substring(z.y, j, 1), {1 << k}, 0)" for k in range(width))
    zero = f"((((m & acc.p) + acc.p) ^ acc.p) | m | acc.n) & {full}"
    # one column is two steps: the diagonal zeros first, then what follows from them
    diagonal = (f"named_struct('p', acc.p, 'n', acc.n, 'd', {zero}, 's', "
                f"acc.s + 1 - (shiftright({zero}, {cell}) & 1))")
    plus = f"((x.n | ~(x.d | x.p)) & {full})"
    follow = (f"transform(array({diagonal}), x -> named_struct("
              f"'p', ((x.d & x.p) | ~(shiftright(x.d, 1) | {plus})) & {full}, "
              f"'n', shiftright(x.d, 1) & {plus}, 'd', x.d, 's', x.s))[0]")
    column = f"transform(array({equal}), m -> {follow})[0]"
    # columns go by blocks, so that characters are looked up in short strings
    cut = (f"named_struct('x', concat(repeat('\0', greatest(0, {e} - k * {block})), "
           f"substring({a}, greatest(1, k * {block} - {e} + 1), {block} + {2 * e} + least(0, k * {block} - {e})), "
           f"repeat('\0', {width})), 'y', substring({b}, k * {block} + 1, {block}))")
    blocks = (f"transform(array({cut}), z -> aggregate(sequence(1, length(z.y)), far, "
              f"(acc, j) -> if(acc.s > {e}, acc, {column})))[0]")
    return (f"if(abs(length({a}) - length({b})) > {e}, {e + 1}, if(length({b}) = 0, length({a}), "
            f"aggregate(sequence(0, cast((length({b}) - 1) / {block} as int)), {start}, "
            f"(far, k) -> if(far.s > {e}, far, {blocks}), far -> far.s)))")


def verified(pairs: DataFrame, max_edits: int) -> DataFrame:
    """Pairs of lines (a, b) with a column ``edits``, those within ``max_edits``."""
    # explode() of one value keeps what is computed once from being inlined again
    begin = common_beginning("a", "b", "least(length(a), length(b))")
    rest = (pairs.select("*", F.explode(F.array(F.expr(begin))).alias("_same"))
            .select(*pairs.columns, F.expr("substring(a, _same + 1)").alias("_x"),
                    F.expr("substring(b, _same + 1)").alias("_y")))
    found = rest.select(*pairs.columns, F.explode(F.array(F.expr(edit_distance("_x", "_y", max_edits)))).alias("edits"))
    return found.where(F.col("edits") <= max_edits)


BROADCAST_IDS = 500_000


def chosen(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose id is among ``ids`` (distinct); ids go to all
    executors if they are few, so that texts are not shuffled for them."""
    few = ids.count() <= BROADCAST_IDS
    return lines.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def with_letters(lines: DataFrame, buckets: int = 32) -> DataFrame:
    """Adds how many letters of the line fall into each of ``buckets`` hash
    buckets, and what one edit can change there: two, or four where characters
    of two code units are split."""
    chars = "split(line, '')"
    count = (f"transform(sequence(0, {buckets - 1}), k -> size(filter(cells, c -> c = k)))")
    cells = F.expr(f"transform({chars}, c -> cast(pmod(xxhash64(c), {buckets}) as int))")
    return (lines.withColumn("cells", cells).withColumn("letters", F.explode(F.array(F.expr(count))))
            .withColumn("step", F.when(F.col("line").rlike(r"[\x{10000}-\x{10FFFF}]"), 4).otherwise(2)).drop("cells"))


def met(entries: DataFrame, probes: DataFrame, letters: DataFrame, max_edits: int) -> DataFrame:
    """Pairs (a, b) of ids that share a key and whose letters are near enough."""
    left = entries.join(letters.select("id", "letters", "step"), "id")
    right = probes.join(letters.select(F.col("id").alias("id2"), F.col("letters").alias("letters2"),
                                       F.col("step").alias("step2")), "id2")
    apart = F.expr("aggregate(zip_with(l.letters, r.letters2, (x, y) -> abs(x - y)), 0, (t, x) -> t + x)")
    near = apart <= F.greatest(F.col("l.step"), F.col("r.step2")) * max_edits
    pairs = left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.id") != F.col("r.id2")) & near)
    return pairs.select(F.least("l.id", "r.id2").alias("a"), F.greatest("l.id", "r.id2").alias("b")).distinct()


def line_links(lines: DataFrame, max_edits: int = 2, hot: int = 16, crowded: int = 2_000) -> DataFrame:
    """Distinct lines (id, line, len) -> links (a, b, edits), a < b, each pair once."""
    if max_edits == 0:
        return lines.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).alias("edits")).limit(0)
    entries = stored(with_keys(lines, max_edits + 1, one_place(max_edits, False), "id"), "segments")
    probes = with_keys(lines, max_edits + 1, one_place(max_edits, True), "id2")
    busy = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot), "hot-segments")
    # Probes, twelve and more a line, are made and shuffled once: a key meets its calm entries
    # or, if it is busy, one row that says so.  That side is hashed, about ``hot`` rows a key
    # at most; the probes are not sorted.
    some_busy = not busy.isEmpty()
    indexed = entries.join(busy, "key", "left_anti").select("id", "key", F.lit(None).cast("long").alias("n"))
    if some_busy:
        indexed = indexed.unionByName(busy.select(F.lit(None).cast("long").alias("id"), "key", "n"))
    hits = probes.join(indexed.hint("shuffle_hash"), "key").where(F.col("n").isNotNull() | (F.col("id") != F.col("id2")))
    if some_busy:
        hits = stored(hits.select("id", "id2", F.when(F.col("n").isNotNull(), F.col("key")).alias("key"), "n"), "line-hits")
    pairs = (hits.where(F.col("n").isNull())
             .select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct())
    if some_busy:
        own = stored(entries.join(busy, "key"), "hot-entries")
        seek = hits.where(F.col("n").isNotNull()).select("id2", "key", "n")
        ids = own.select("id").unionByName(seek.select(F.col("id2").alias("id"))).distinct()
        some = stored(with_letters(chosen(lines, ids)), "hot-lines")
        calm = F.col("n") <= crowded
        pairs = pairs.unionByName(met(own.where(calm), seek.where(calm), some, max_edits))
        stems, seekers = own.where(~calm).select("id").distinct(), seek.where(~calm).select(F.col("id2").alias("id")).distinct()
        if not stems.isEmpty():
            pairs = pairs.unionByName(met(
                with_keys(chosen(some, stems), max_edits + 2, two_places(max_edits, False), "id"),
                with_keys(chosen(some, seekers), max_edits + 2, two_places(max_edits, True), "id2"), some, max_edits))
        pairs = pairs.distinct()
    pairs = stored(pairs, "line-pairs")
    texts = chosen(lines.select("id", "line"), pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    texts = stored(texts, "line-texts")
    both = (pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")
            .select(F.col("a").alias("id_a"), F.col("b").alias("id_b"),
                    F.col("line_a").alias("a"), F.col("line_b").alias("b")))
    return verified(both, max_edits).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "edits")


def one_edit_links(lines: DataFrame) -> DataFrame:
    """Distinct short lines (id, line, len) -> links (a, b, edits) of one edit.  Two lines
    that differ in one character are equal without it, at the same place; of two that
    differ by one character more, the shorter is the longer without it.  So lines meet
    on (rest, place) or on the rest itself, and all that meet are links: a rest that
    many lines share costs no pair that is not in the result."""
    cut = F.expr("transform(sequence(1, len), i -> named_struct('at', i, "
                 "'left', xxhash64(concat(substring(line, 1, i - 1), substring(line, i + 1)))))")
    rests = lines.select("id", F.explode(cut).alias("c")).select("id", "c.at", "c.left")
    other = rests.select(F.col("id").alias("id2"), "at", "left")
    swapped = rests.join(other, ["left", "at"]).where("id < id2").select(F.col("id").alias("id_a"), F.col("id2").alias("id_b"))
    whole = lines.select(F.col("id").alias("id2"), F.xxhash64("line").alias("left"))
    longer = (rests.select("id", "left").distinct().join(whole, "left")
              .select(F.least("id", "id2").alias("id_a"), F.greatest("id", "id2").alias("id_b")))
    pairs = swapped.unionByName(longer).distinct()
    both = (pairs.join(lines.select(F.col("id").alias("id_a"), F.col("line").alias("a")), "id_a")
            .join(lines.select(F.col("id").alias("id_b"), F.col("line").alias("b")), "id_b"))
    return verified(both, 1).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "edits")


def scaled_links(lines: DataFrame, max_edits: int, min_chars: int, hot: int) -> DataFrame:
    """Distinct lines of any length (id, line, len) -> links (a, b, edits) within
    ``max_edits``, and within ``len * max_edits / min_chars`` of the shorter line."""
    links = line_links(lines.where(F.col("len") >= min_chars), max_edits, hot)
    for e in range(1, max_edits):
        first, after = (-(-min_chars * k // max_edits) for k in (e, e + 1))
        some = lines.where(F.col("len").between(first, after - 1 + e))
        links = links.unionByName(one_edit_links(some) if e == 1 else line_links(some, e, hot))
    # lines just above a bound meet twice
    return links.distinct()


def without_end_blanks(line: Column) -> Column:
    """The pattern looks at every blank of a line, so only lines that end in one meet it."""
    ends = [F.endswith(line, F.lit(c)) for c in " \t\n\x0b\x0c\r"]
    return F.when(reduce(Column.__or__, ends), F.regexp_replace(line, r"[\x20\x09-\x0D]+$", "")).otherwise(line)


def line_classes(docs: DataFrame, max_edits: int = 2, min_chars: int = 24, hot: int = 16,
                 carry: tuple[str, ...] = (), every_line: bool = False) -> DataFrame:
    """Every line that takes part: doc_id, line_no (from 0), n_links (other line
    texts linked directly), class_doc and class_line (the first line of its
    class of linked or equal lines), kept (it is that line), and ``carry``."""
    each = (docs.select("doc_id", *carry, F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
            .withColumn("line", without_end_blanks(F.col("line")))
            .where(F.char_length("line") >= (1 if every_line else min_chars)))
    key = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]
    slim = stored(each.select("doc_id", *carry, "line_no", *key), "line-rows")
    lines = (each.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
             .select(F.monotonically_increasing_id().alias("id"), "line", F.char_length("line").alias("len"), *key))
    lines = stored(lines, "lines")
    texts = lines.select("id", "line", "len")
    # its indexes and candidates are removed before the next step fills the disk
    links = settled(lambda: scaled_links(texts, max_edits, min_chars, hot) if every_line
                    else line_links(texts, max_edits, hot), "line-links")
    roots = connected_components(links.select("a", "b"))
    degree = (links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id")
              .agg(F.count(F.lit(1)).alias("n_links")))
    linked = (lines.select("id", "h1", "h2").join(roots.withColumnRenamed("node", "id"), "id").join(degree, "id"))
    named = slim.join(stored(linked.select("h1", "h2", "root", "n_links"), "line-classes"), ["h1", "h2"], "left")
    # equal lines are a class of their own where they have no link
    named = stored(named.select("doc_id", *carry, "line_no", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                                F.when(F.col("root").isNull(), F.col("h1")).otherwise(F.col("root")).alias("c1"),
                                F.when(F.col("root").isNull(), F.col("h2")).alias("c2")), "line-named")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("line_no"), *[F.col(c) for c in carry])
    first = named.groupBy("c1", "c2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = stored(first.where("n > 1"), "line-first")
    out = named.join(shared.alias("f"), (named.c1 == F.col("f.c1")) & named.c2.eqNullSafe(F.col("f.c2")), "left")
    found = F.coalesce(F.col("f.first"), place)
    return out.select(named.doc_id, *[named[c] for c in carry], named.line_no, "n_links",
                      found["doc_id"].alias("class_doc"), found["line_no"].alias("class_line"),
                      (F.col("f.first").isNull() | (F.col("f.first") == F.struct(
                          named.doc_id.isNull().alias("none"), named.doc_id, named.line_no,
                          *[named[c] for c in carry]))).alias("kept"))


def drop_repeated_lines(docs: DataFrame, max_edits: int = 2, min_chars: int = 24, hot: int = 16) -> DataFrame:
    """``docs`` without the lines that repeat an earlier line (or nearly so);
    ``n_chars`` follows the text, all other columns and all rows stay."""
    uid, gone = clear_name(docs.columns, "uid"), clear_name(docs.columns, "gone")
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "line-input")
    dropped = (line_classes(rows, max_edits, min_chars, hot, carry=(uid,)).where(~F.col("kept"))
               .groupBy(uid).agg(F.collect_set("line_no").alias(gone)))  # at most the lines of one text
    joined = rows.join(dropped, uid, "left")
    kept = F.filter(F.split(F.col("text").cast("string"), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i))
    change = {c: F.when(F.col(gone).isNull(), F.col(c)).otherwise(F.array_join(kept, "\n"))
              for c in docs.columns if c.lower() == "text"}
    out = joined.withColumns(change)
    follow = {c: F.when(F.col(gone).isNull(), F.col(c)).otherwise(
        F.char_length("text").cast(docs.schema[c].dataType)) for c in docs.columns if c.lower() == "n_chars"}
    return (out.withColumns(follow) if follow else out).select(*docs.columns)
