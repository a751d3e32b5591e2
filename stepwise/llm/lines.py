"""Fuzzy line deduplication by MinHash (operator 7; DataFrame only).

Lines (cut at line feeds) are sets of ``SHINGLE``-character shingles; lines of
a Jaccard similarity of ``SIMILARITY`` or more are linked, and of each
connected group of lines the first one of the corpus stays (smallest document,
then line). Copies of a line go with it.

* Copies collapse first, before the shuffle, so a line that every document
  holds is one row.
* The signature is a one-permutation MinHash: the range of shingle hashes is
  cut in ``BANDS x ROWS`` bins, and the smallest hash of each bin is kept. One
  sort gives all of them, and a bin is equal in two lines with a probability of
  their similarity. Bins without a shingle are equal, too; bands without any
  are left out. Two lines of similarity 0.8 meet in one of 12 bands of 4 bins
  with a probability of 0.998, and with more the more similar they are.
* Lines that meet in a band are compared by their whole shingle sets: first
  each line of a bucket with the bucket's first one; then all pairs of a bucket
  that are of different groups still (a line without a link is a group) and
  whose marks allow the similarity. A mark is a bitmap of shingle hashes; a bit
  that differs is a shingle of one set only, so no similar pair is left out. In
  buckets of over ``PAIRS_UP_TO`` lines hashes of 32 bits are looked at, too, in
  the same way. In those of over ``MARKS_A_PAIR`` times as many, links between
  groups are found by an exact prefix filter instead. So buckets have no cap,
  and no group of similar lines makes all its pairs.
* Groups are found by distributed union-find (``components``).

Lines are known by 128 bits of hash, groups by 64.

Defined results: a null text stays null with no lines; an empty text is one blank
line; blank lines (white space only) are left as they are and take no part; a
line shorter than a shingle is one shingle; a character beyond the basic plane
counts as two; null ids come before all others;
rows of one id are ordered by text hash; rows equal in id and text are one
document, and each gets its result; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepwise.llm.components import connected_components, split_join
from stepwise.llm.scratch import materialize, settings, shuffle_partitions

SHINGLE = 8
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
PAIRS_UP_TO = 32
#: Marks that are held against each other in the time of one comparison of lines, or less.
MARKS_A_PAIR = 512
#: Lines whose least hashes a task holds at once.
LINES_PER_TASK = 1 << 15
#: Longs of a line's mark, and those that one row of the aggregate makes.
WORDS, _AT_ONCE = 32, 8

#: Shuffle files go when the table that they were made for is written.
_CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: As many groups as a task holds find room in the map that generated code looks into first.
_MANY_GROUPS = {
    "spark.sql.codegen.aggregate.fastHashMap.capacityBit": "20",
    "spark.sql.codegen.aggregate.map.twolevel.partialOnly": "false",
}
#: Rows whose key the other side hasn't got are dropped by a Bloom filter of its
#: keys, before they are shuffled.
_FEW_MEET = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
}

_DOC = ["has_id", "doc_id", "text_hash"]
#: For joins inside buckets of bounded size: split on both sides, a bucket would be
#: read once for each pair of parts; long conditions are compiled as short functions.
_IN_BUCKETS = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.codegen.wholeStage": "false"}


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").isNotNull().alias("has_id"),  # false sorts first
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        "text",
    )


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _with_shingles(df: DataFrame, line: str, out: str) -> DataFrame:
    """Adds the hashes of the shingles of a line (with repeats). One regular
    expression cuts all of them; it steps by UTF-16 units. Where every character
    is one byte, the shingles are cut from the bytes: the same, at less cost."""
    cut = f"{out}_cut"
    plain = f"(octet_length({line}) = length({line}) and length({line}) >= {SHINGLE})"
    of_bytes = (
        f"transform(array(cast({line} as binary)),"
        f" b -> transform(sequence(1, octet_length(b) - {SHINGLE - 1}), i -> xxhash64(substring(b, i, {SHINGLE}))))[0]"
    )
    return (
        df.withColumn(cut, F.expr(f"if({plain}, null, regexp_extract_all({line}, '(?s)(?=(.{{{SHINGLE}}}))', 1))"))
        .withColumn(out, F.expr(f"if({plain}, {of_bytes}, transform(if(size({cut}) > 0, {cut}, array({line})), x -> xxhash64(x)))"))
        .drop(cut)
    )


def _starts(units: str) -> str:
    """Where the shingles start in the UTF-16 units of a line."""
    return f"sequence(1, greatest(octet_length({units}) - {2 * SHINGLE - 2}, 1), 2)"


#: Whether a line has characters beyond the basic plane.
_WIDE = "octet_length(encode(line, 'UTF-16BE')) > 2 * length(line)"


def _as_text(units: str) -> str:
    """The UTF-16 units of a shingle as they are in a text: half of a character
    beyond the basic plane, in front or at the end, is a question mark there."""
    front = f"if(substring({units}, 1, 1) between X'DC' and X'DF', X'003F', substring({units}, 1, 2))"
    end = f"if(substring({units}, {2 * SHINGLE - 1}, 1) between X'D8' and X'DB', X'003F', substring({units}, {2 * SHINGLE - 1}, 2))"
    return f"concat({front}, substring({units}, 3, {2 * SHINGLE - 4}), {end})"


def _shingles(lines: DataFrame, as_text: bool = False) -> DataFrame:
    """``id, hash``: the shingles of each line (with repeats) as rows, cut from
    its UTF-16 units, so that cutting and hashing are generated code."""
    cut = f"substring(units, at, {2 * SHINGLE})"
    return (
        lines.select("id", F.encode("line", "UTF-16BE").alias("units"), F.expr(_WIDE).alias("wide"))
        .select("id", "units", "wide", F.explode(F.expr(_starts("units"))).alias("at"))
        .select("id", F.expr(f"if(wide, xxhash64({_as_text(cut)}), xxhash64({cut}))" if as_text else f"xxhash64({cut})").alias("hash"))
    )


def _bands(lines: DataFrame) -> DataFrame:
    """``key, id``: the non-empty bands of each line.

    Lines are dealt by id first: a line's shingles then meet where they are
    cut, and the least hash of each bin is generated code, too.
    """
    tasks = max(shuffle_partitions(lines.sparkSession), -(-lines.count() // LINES_PER_TASK))
    bins = BANDS * ROWS
    least = [f"least_{row}" for row in range(ROWS)]
    return (
        _shingles(lines.repartition(tasks, "id"))
        # The hash range in equal parts.
        .select("id", "hash", F.expr(f"cast(shiftright((shiftright(hash, 40) + {1 << 23}) * {bins}, 24) as int)").alias("bin"))
        .groupBy("id", F.expr(f"cast(bin div {ROWS} as int)").alias("band"))
        .agg(*[F.min(F.when(F.col("bin") % ROWS == row, F.col("hash"))).alias(name) for row, name in enumerate(least)])
        .select(F.xxhash64("band", *least).alias("key"), "id")
    )


def _bits(words: int) -> list[str]:
    return [f"bits_{k}" for k in range(words)]


def _marked(lines: DataFrame) -> DataFrame:
    """``id, line, mark``: with the number of a line's shingles (with repeats)
    and a bitmap of their hashes. Lines are dealt by id, once for all steps."""
    lines = lines.repartition(shuffle_partitions(lines.sparkSession), "id")
    bit = "shiftleft(1L, cast(shiftright(hash, 32) & 63 as int))"
    some = [F.expr(f"bit_or(if((hash & {_AT_ONCE - 1}) = {k}, {bit}, 0L))").alias(f"some_{k}") for k in range(_AT_ONCE)]
    part = F.expr(f"cast(shiftright(hash, 38) & {WORDS // _AT_ONCE - 1} as int)")
    parts = _shingles(lines, as_text=True).groupBy("id", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), *some)
    bits = [F.expr(f"max(if(part = {k // _AT_ONCE}, some_{k % _AT_ONCE}, null))").alias(name) for k, name in enumerate(_bits(WORDS))]
    marks = parts.groupBy("id").agg(F.sum("n").alias("most"), *bits)
    mark = F.struct("most", *[F.coalesce(name, F.lit(0)).alias(name) for name in _bits(WORDS)])
    return lines.join(marks.select("id", mark.alias("mark")), "id")


def _hopeful(a: str, b: str, similarity: float) -> Column:
    """Whether lines of the marks ``a`` and ``b`` can be similar. Each bit that
    differs is a shingle of one set only, and sets of a similarity s differ in
    (1 - s) / (1 + s) of their summed sizes at most; so no similar pair is lost."""
    differ = F.expr(" + ".join(f"bit_count({a}.{name} ^ {b}.{name})" for name in _bits(WORDS)))
    return _few_differ(differ, a, b, similarity)


def _few_differ(differ: Column, a: str, b: str, similarity: float) -> Column:
    return differ * (1 + similarity) <= F.expr(f"{a}.most + {b}.most") * (1 - similarity) + 1e-6


def _similar(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``u, v`` of lines whose shingle sets are similar. Where
    ``lines`` have marks, sets are made for pairs that can be similar only."""
    ends = materialize(pairs, "pairs")  # its size is known: few pairs are broadcast
    marked = "mark" in lines.columns
    for end in ("u", "v"):
        ends = split_join(ends, lines.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("line", "mark")[: 1 + marked]]), [end])
    hopeful = _hopeful("mark_u", "mark_v", similarity) if marked else F.lit(True)
    ends = ends.select("u", "v", *[F.when(hopeful, F.col(f"line_{end}")).alias(f"line_{end}") for end in "uv"])
    # Cut from UTF-16 units, as one regular expression would, but for pairs with
    # characters beyond the basic plane: half of one is no text.
    ends = ends.withColumn("wide", F.expr(" or ".join(f"octet_length(encode(line_{end}, 'UTF-16BE')) > 2 * length(line_{end})" for end in "uv")))
    for end in ("u", "v"):
        of_units = (
            f"transform(array(encode(line_{end}, 'UTF-16BE')),"
            f" b -> transform({_starts('b')}, i -> xxhash64(substring(b, i, {2 * SHINGLE}))))[0]"
        )
        ends = _with_shingles(ends.withColumn("rare", F.expr(f"if(wide, line_{end}, null)")), "rare", "rare_hashes")
        ends = ends.withColumn(f"all_{end}", F.expr(f"if(line_{end} is null, null, if(wide, rare_hashes, {of_units}))")).drop("rare", "rare_hashes")
    both = ends.select("u", "v", "all_u", "all_v", F.size(F.array_intersect("all_u", "all_v")).alias("shared"))
    # Sets are at most as large as the lists with repeats; where that is enough, their sizes aren't needed.
    listed = F.size("all_u") + F.size("all_v") - F.col("shared")
    union = F.size(F.array_distinct("all_u")) + F.size(F.array_distinct("all_v")) - F.col("shared")
    near = F.when(F.col("shared") >= F.lit(similarity) * listed, True).otherwise(F.col("shared") >= F.lit(similarity) * union)
    return materialize(both.select("u", "v", F.coalesce(near, F.lit(False)).alias("near")), "compared")


def _placed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds the ``component``: a line without a link is a group."""
    of = groups.select(F.col("node").alias("id"), "component")
    return split_join(rows, of, ["id"], "left").withColumn("component", F.coalesce("component", "id"))


def _apart(rows: DataFrame, groups: DataFrame, lines: DataFrame, similarity: float, *, crowd: bool) -> DataFrame:
    """The pairs ``u, v`` of lines of one bucket (``key, id``) that are of
    different groups and can be similar by what goes with the rows, in the join
    itself: by their marks and, in crowds, where a line is in very many pairs, by
    their shingles in 32 bits (as in marks, what differs there differs) and their
    number without repeats. Of the buckets in which a pair meets the first one
    gives it."""
    placed = materialize(_placed(rows.select("key", "id"), groups), "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b")
    placed = split_join(placed, mixed.select("key"), ["key"])
    of_line = placed.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    held = split_join(of_line, lines.select("id", "line", "mark"), ["id"])
    if crowd:
        def cut(of: str) -> str:
            one = f"substring(b, i, {2 * SHINGLE})"
            all_of = "transform(array(encode(line, 'UTF-16BE')), b -> transform({}, i -> {}({})))[0]"
            return f"array_distinct(if({_WIDE}, {all_of.format(_starts('b'), of, _as_text(one))}, {all_of.format(_starts('b'), of, one)}))"

        held = held.withColumn("shingles", F.expr(cut("hash")))
        held = held.withColumn("mark", F.col("mark").withField("most", F.expr(f"cast(size({cut('xxhash64')}) as long)")))
    held = held.drop("line")
    left = materialize(split_join(placed, held, ["id"]), "apart")
    right = left.select("key", *[F.col(c).alias(f"{c}_v") for c in left.columns if c != "key"])
    meet = (
        (F.col("id") < F.col("id_v"))
        & (F.col("component") != F.col("component_v"))
        & _hopeful("mark", "mark_v", similarity)
        & (F.array_min(F.array_intersect("keys", "keys_v")) == F.col("key"))
    )
    if crowd:
        differ = F.size("shingles") + F.size("shingles_v") - 2 * F.size(F.array_intersect("shingles", "shingles_v"))
        meet &= _few_differ(differ, "mark", "mark_v", similarity)
    return left.join(right, "key").where(meet).select(F.col("id").alias("u"), F.col("id_v").alias("v"))


def _across(rim: DataFrame, links: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Links between the groups of ``links``, for the lines ``key, id`` of
    ``rim`` in buckets that hold several groups (a line without a link is one).

    Shingles are ranked, those of few groups first: what one group alone holds
    leads to no other. Before the first shingle that two sets share, neither has
    a shared one, so as many as a similar pair shares must follow in both: only
    pairs that meet early enough in both are compared.
    """
    placed = materialize(_placed(rim, links), "rim")
    mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b")
    open_lines = split_join(placed, mixed.select("key"), ["key"]).select("id", "component").distinct()
    sets = _with_shingles(split_join(open_lines, lines.select("id", "line"), ["id"]), "line", "hashes")
    sets = materialize(
        sets.select("id", "component", F.array_distinct("hashes").alias("hashes")).withColumn("n", F.size("hashes")), "rim-sets"
    )
    held = sets.select("id", "component", "n", F.explode("hashes").alias("shingle"))
    # By groups, not by lines: a large group's own shingles are rare.
    often = held.select("shingle", "component").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = split_join(held, materialize(often, "rim-shingles"), ["shingle"]).groupBy("id", "component", "n").agg(
        F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked")
    )
    met = ranked.select("id", "component", "n", F.posexplode("ranked").alias("at", "one")).select(
        F.col("one.shingle").alias("shingle"), "id", "component", "n", (F.col("n") - F.col("at")).alias("rest"), F.col("one.often").alias("often")
    )
    met = materialize(met.where((F.col("often") > 1) & (F.col("rest") >= F.lit(similarity) * F.col("n") - 1e-6)).drop("often"), "rim-prefixes")
    # Which groups meet, before their lines do: a group doesn't meet itself.
    groups = met.groupBy("shingle", F.col("component").alias("other")).agg(F.lit(True).alias("there"))
    asked = split_join(met, groups.drop("there"), ["shingle"]).where(F.col("component") < F.col("other"))
    others = met.select("shingle", *[F.col(c).alias(t) for c, t in (("component", "other"), ("id", "id2"), ("n", "n2"), ("rest", "rest2"))])
    pairs = (
        split_join(asked, others, ["shingle", "other"])
        .where(F.least("rest", "rest2") * (1 + similarity) >= F.lit(similarity) * (F.col("n") + F.col("n2")) - 1e-6)
        .select(F.least("id", "id2").alias("u"), F.greatest("id", "id2").alias("v"))
        .distinct()
    )
    return _similar(pairs, lines, similarity).where("near").select("u", "v")


def _links(lines: DataFrame, similarity: float, pairs_up_to: int) -> DataFrame:
    spark = lines.sparkSession
    with settings(spark, _MANY_GROUPS):
        bands = materialize(_bands(lines), "bands")
        # Counted by partial aggregation and joined back, so that a hot bucket can be split.
        # Written, so that their size is known: few keys are broadcast, and the bands stay where they are.
        sizes = materialize(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "sizes")
    with settings(spark, _FEW_MEET):
        met = materialize(split_join(bands, sizes.where(F.col("n") > 1), ["key"]), "buckets")
        # From here on only lines that meet others: every comparison joins the texts twice.
        lines = materialize(lines.join(met.where(F.col("n") > 1).select("id"), "id", "left_semi"), "meeting")
    lines = materialize(_marked(lines), "marks")
    # First every line of a bucket with the first one.
    first = Window.partitionBy("key").orderBy("id")
    heads = met.withColumn("nr", F.row_number().over(first)).where(F.col("nr") == 1)
    heads = materialize(heads.select("key", F.col("id").alias("head")), "heads")
    asked = split_join(met, heads, ["key"]).where(F.col("id") != F.col("head"))
    pairs = asked.select(F.least("head", "id").alias("u"), F.greatest("head", "id").alias("v")).distinct()
    links = _similar(pairs, lines, similarity).where("near").select("u", "v")
    # Then all pairs of a bucket that are of different groups still and whose marks allow it.
    marks_up_to = pairs_up_to * MARKS_A_PAIR
    more = met.where(F.col("n") > 2)
    if not more.limit(1).count():
        return links
    groups = materialize(connected_components(links), "stars-joined")
    rest = _apart(more.where(F.col("n") <= pairs_up_to), groups, lines, similarity, crowd=False)
    crowd = materialize(more.where((F.col("n") > pairs_up_to) & (F.col("n") <= marks_up_to)), "crowds")
    if crowd.limit(1).count():
        rest = rest.unionByName(_apart(crowd, groups, lines, similarity, crowd=True)).distinct()
    with settings(spark, _IN_BUCKETS):
        rest = materialize(rest, "rest")
    if rest.limit(1).count():
        links = links.unionByName(_similar(rest, lines, similarity).where("near").select("u", "v"))
    masses = more.where(F.col("n") > marks_up_to)
    if not masses.limit(1).count():
        return links
    return links.unionByName(_across(masses.select("key", "id"), groups, lines, similarity))


def kept_lines(docs: DataFrame, *, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """``has_id, doc_id, text_hash, kept``: numbers (from 0) of the lines that
    are the first of their group, for documents that have any."""
    place = F.struct("has_id", "doc_id", "text_hash", "number", "line")
    occurring = (
        _keyed(docs)
        .select(*_DOC, F.posexplode_outer(_lines(F.col("text"))).alias("number", "line"))
        .where(F.col("line").rlike(r"\S"))
        .select(F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2"), place.alias("place"))
    )
    firsts = materialize(occurring.groupBy("id", "id2").agg(F.min("place").alias("place")).select("id", "place.*"), "lines")
    links = _links(firsts.select("id", "line"), similarity, pairs_up_to)
    groups = connected_components(links).withColumnRenamed("node", "id")
    grouped = firsts.drop("line").join(materialize(groups, "groups"), "id", "left")
    # A line without links stays by itself; of a group the first one stays.
    alone = grouped.where(F.col("component").isNull()).select(*_DOC, "number")
    place = F.struct(*_DOC, "number")
    of_groups = (
        grouped.where(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min(place).alias("place"))
        .select("place.*")
    )
    return alone.unionByName(of_groups).groupBy(*_DOC).agg(F.collect_set("number").alias("kept"))


def dedup_lines(docs: DataFrame, *, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_lines, n_removed, text``
    (the lines that stay)."""
    with settings(docs.sparkSession, _CLEAN):
        kept = materialize(kept_lines(docs, similarity=similarity, pairs_up_to=pairs_up_to), "kept")
    # Kept and blank lines by number, in order: no search per line.
    blank = r"filter(sequence(0, size(lines) - 1), i -> not lines[i] rlike '\\S')"
    stay = F.expr(f"transform(sort_array(concat(coalesce(kept, cast(array() as array<int>)), {blank})), i -> lines[i])")
    # Cut after the join, which would carry the texts twice otherwise.
    out = _keyed(docs).join(kept, _DOC, "left").withColumn("lines", _lines(F.col("text"))).withColumn("stay", stay)
    none = F.lit(0)
    return out.select(
        F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), none).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines") - F.size("stay")), none).cast("long").alias("n_removed"),
        F.array_join("stay", "\n").alias("text"),
    )
