"""Document fingerprints by spot signatures, with DataFrame functions only.

A signature is a chain of content words that follows a common word. The set of a text's
signatures, as sorted 32-bit hashes, is its fingerprint; two fingerprints are as alike as
the Jaccard similarity of their sets. Sets are partitioned by their size, so wide that sets
alike enough lie in the same partition or in neighbours; a given pair is compared only there,
and only if its sizes allow the least likeness that counts. To find all near copies, sets meet
in those partitions at their rarest signatures, and bounds prune pairs before they are compared.

Defined cases: words are runs of letters, lower-cased; in a text without a common word before
a whole chain, chains start at every content word; a text too short for a chain has one
signature, that of the text itself; an empty or null text has
an empty fingerprint; two empty fingerprints are alike (1), one empty one is like no other
(0); equal texts have equal fingerprints; whole texts of any length count; repeated rows
each get their row; other input columns pass through. A null or repeated key is a key like any
other: rows of one key follow each other by the hash of their text, a null key comes first of
all. A likeness below the least that counts is 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import set_join
from tallyline.llm.arrow import column
from tallyline.llm.components import components
from tallyline.session import materialize

CHAIN = 3
# Hexadecimal digits of a signature in a fingerprint.
DIGITS = 8

# Common words that start a chain, by language.
COMMON = {
    "en": "the a an of and to in is was are be it that this for on with as at by or from not have has",
    "de": "der die das und ist nicht ein eine in den dem des zu mit von auf für im sich auch als an es",
    "fr": "le la les de des du et est un une dans que qui pour pas sur par au avec il elle ne se ce",
    "es": "el la los las de del y que en un una es por con para se su al lo como no más",
}


def common_words() -> list[str]:
    return sorted({w for words in COMMON.values() for w in words.split()})


def _low_bits(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << 32))


def with_signatures(
    docs: DataFrame, *, text: str = "text", name: str = "signatures", chain: int = CHAIN
) -> DataFrame:
    """``docs`` with the sorted distinct signatures of a text, numbers below 2**32.

    Each step is a projection of its own: an array that a function reads more than once is
    worked out once, and no function of elements repeats work on the whole text."""
    steps = {s: f"_{name}_{s}" for s in ("text", "words", "before", "content", "whole", "spots", "chains")}
    plain = docs.withColumn(steps["text"], F.coalesce(column(text), F.lit("")))
    words = F.regexp_extract_all(F.lower(steps["text"]), F.lit(r"\p{L}+"), F.lit(0))
    found = plain.withColumn(steps["words"], words)
    found = found.withColumn(steps["before"], F.concat(F.array(F.lit("")), F.col(steps["words"])))
    # Content words, each with whether a common word stands before it.
    common = common_words()
    pairs = F.arrays_zip(steps["words"], steps["before"])
    content = F.filter(pairs, lambda p: p[steps["words"]].isNotNull() & ~p[steps["words"]].isin(common))
    marked = F.transform(
        content,
        lambda p: F.struct(p[steps["words"]].alias("word"), p[steps["before"]].isin(common).alias("starts")),
    )
    found = found.withColumn(steps["content"], marked)
    # A chain is a content word and those after it, side by side in shifted arrays.
    shifted = {f"_{name}_{k}": F.slice(F.col(steps["content"]), k + 1, 1 << 30) for k in range(1, chain)}
    found = found.withColumns(shifted)
    places = [steps["content"], *shifted]
    whole = F.filter(F.arrays_zip(*places), lambda p: p[places[-1]]["word"].isNotNull())
    found = found.withColumn(steps["whole"], whole)
    after_common = F.filter(steps["whole"], lambda p: p[places[0]]["starts"])
    found = found.withColumn(steps["spots"], after_common)
    chosen = F.when(F.size(steps["spots"]) > 0, F.col(steps["spots"])).otherwise(F.col(steps["whole"]))
    hashed = F.transform(chosen, lambda p: _low_bits(F.concat_ws(" ", *[p[c]["word"] for c in places])))
    found = found.withColumn(steps["chains"], F.array_sort(F.array_distinct(hashed)))
    none = F.when(F.col(steps["text"]) == "", F.array().cast("array<bigint>")).otherwise(
        F.array(_low_bits(F.col(steps["text"])))
    )
    signatures = F.when(F.size(steps["chains"]) > 0, F.col(steps["chains"])).otherwise(none)
    return found.withColumn(name, signatures).drop(*steps.values(), *shifted)


def fingerprint(signature_set: Column) -> Column:
    """The signatures as one string of hexadecimal digits."""
    digits = F.transform(signature_set, lambda s: F.lpad(F.lower(F.hex(s)), DIGITS, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    overlap = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - overlap
    return F.when(union == 0, F.lit(1.0)).otherwise(overlap / union)


def size_partition(n: Column, percent: int) -> Column:
    """The partition of a set of n tokens: sets of a similarity of ``percent``/100 or more
    are in the same one or in neighbours. An empty set has none."""
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent))))


# The least likeness of a pair that counts, in percent.
LEAST_LIKENESS = 10


def pruned_likeness(a: Column, b: Column, percent: int = LEAST_LIKENESS) -> Column:
    """:func:`likeness` of sets that lie in the same or in neighbouring partitions by size and
    whose sizes allow ``percent``/100, if it reaches that; else 0."""
    sizes = F.size(a), F.size(b)
    parts = [size_partition(n, percent) for n in sizes]
    near = F.abs(parts[0] - parts[1]) <= 1
    # Sets of these sizes share at most the smaller one.
    able = 100 * F.least(*sizes) >= percent * F.greatest(*sizes)
    alike = likeness(a, b)
    empty = (sizes[0] == 0) & (sizes[1] == 0)
    # A branch is worked out only if the ones before it do not hold.
    return F.when(empty, F.lit(1.0)).when(F.coalesce(~(near & able), F.lit(True)), F.lit(0.0)).otherwise(
        F.when(alike * 100 >= percent, alike).otherwise(F.lit(0.0))
    )


# ---- near copies -------------------------------------------------------------------


def near_copies(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80, chain: int = CHAIN
) -> DataFrame:
    """One row per document: key and component_id, the smallest key among the documents
    that links of a likeness of ``percent``/100 or more lead to. A document without a
    fingerprint or without a key links with nothing.

    Sizes are cut into partitions so wide that linked sets lie in the same or in the next
    one; sets meet there at the tokens of their prefixes, equal ones as one class."""
    named = docs.select(column(key).alias("key"), column(text).alias("text"))
    found = with_signatures(named, name="tokens", chain=chain).select(
        F.monotonically_increasing_id().alias("row"), "key", F.size("tokens").cast("long").alias("n"), "tokens"
    )
    found = materialize(
        found.withColumns({"s1": F.xxhash64("tokens"), "s2": F.hash("tokens")}), "fingerprints"
    )
    classes = found.filter("n > 0 and key is not null").groupBy("s1", "s2")
    classes = materialize(
        classes.agg(
            F.min("row").alias("cid"), F.min("key").alias("key"), F.first("n").alias("n"), F.first("tokens").alias("tokens")
        ),
        "classes",
    )
    sets = classes.select("cid", "n", "tokens")
    part = size_partition(F.col("n"), percent)
    met = set_join.prefixes(sets, percent).withColumn("part", F.explode(F.array(part, part + 1)))
    members = met.select(F.struct("part", "token").alias("meet"), "cid", "n", "own", "place")
    links = set_join.connecting_links(
        members, percent, lambda pairs: set_join.verified(pairs, sets, set_join.similar(percent))
    )
    labels = components(links).withColumnRenamed("node", "cid")
    grouped = classes.join(labels, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    grouped = materialize(grouped.select("s1", "s2", "key", "component"), "grouped")
    least = materialize(grouped.groupBy("component").agg(F.min("key").alias("component_id")), "least")
    linked = materialize(grouped.join(least, "component").select("s1", "s2", "component_id"), "linked")
    placed = found.select("key", "n", "s1", "s2").join(linked, ["s1", "s2"], "left")
    alone = (F.col("n") == 0) | F.col("key").isNull()
    return placed.select(
        F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("component_id")).alias("component_id")
    )


# ---- a text and its successor ------------------------------------------------------

# Rows of a stretch, and the most stretches. Beyond that stretches grow with the table; a
# stretch is sorted by Spark, which spills, so its task needs no more memory for it.
ROWS_PER_STRETCH, MOST_STRETCHES = 1_000, 10_000
_CUTS_PER_GROUP = 100


def _cuts(rows: DataFrame) -> list[tuple]:
    """Where the order of all rows is cut into stretches: (key, hash, salt), a null key as
    None. Quantiles cut between keys. A key of many rows is cut by the hashes of its texts,
    evenly, and a text that repeats under such a key by its rows' salts."""
    total = rows.count()
    limit = max(ROWS_PER_STRETCH, -(-total // MOST_STRETCHES))
    stretches = total // limit
    if stretches < 2:
        return []
    wanted = [i / stretches for i in range(1, stretches)]
    between = rows.select(F.percentile_approx("key", wanted, 10 * MOST_STRETCHES)).first()[0] or []
    lowest = rows.agg(F.min("key")).first()[0]
    cuts = {(k, None, None) for k in between if k != lowest}
    # At most the number of rows divided by the limit, of keys as of texts.
    many = F.col("n") > limit
    hot_keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(many)
    hot_keys = materialize(hot_keys, "hot-keys")
    def parts(n: int) -> list[int]:
        pieces = -(-n // limit)
        return [-(1 << 63) + (1 << 64) * i // pieces for i in range(1, pieces)]

    same = rows.alias("r").join(hot_keys.alias("h"), F.col("r.key").eqNullSafe(F.col("h.key")), "left_semi")
    hot_texts = same.groupBy("key", "hash").agg(F.count(F.lit(1)).alias("n")).filter(many)
    for r in hot_keys.collect():
        cuts |= {(r["key"], h, None) for h in parts(r["n"])}
    for r in hot_texts.collect():
        cuts |= {(r["key"], r["hash"], None)} | {(r["key"], r["hash"], salt) for salt in parts(r["n"])}
    least = -(1 << 63)
    ordered = [(k, least if h is None else h, least if salt is None else salt) for k, h, salt in cuts]
    return sorted(set(ordered), key=lambda c: (c[0] is not None, c[0] if c[0] is not None else 0, c[1], c[2]))


def _stretch(cuts: list[tuple], key_type) -> Column:
    """How many cuts lie at or before a row, found among every hundredth cut first."""
    if not cuts:
        return F.lit(0)

    def literal(cut: tuple) -> Column:
        known, key = cut[0] is not None, F.lit(cut[0]).cast(key_type)
        return F.struct(F.lit(known).alias("known"), key.alias("key"), F.lit(cut[1]).alias("hash"), F.lit(cut[2]).alias("salt"))

    place = F.struct(F.col("key").isNotNull().alias("known"), "key", "hash", "salt")
    groups = [cuts[i : i + _CUTS_PER_GROUP] for i in range(0, len(cuts), _CUTS_PER_GROUP)]
    before = F.size(F.filter(F.array(*[literal(g[0]) for g in groups]), lambda c: c <= place))
    group = F.get(F.array(*[F.array(*map(literal, g)) for g in groups]), before - 1)
    inside = F.size(F.filter(group, lambda c: c <= place))
    return F.when(before == 0, 0).otherwise((before - 1) * _CUTS_PER_GROUP + inside)


def with_next(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    derived: Sequence[str] = (),
) -> DataFrame:
    """Rows (key, text, derived columns, and next_ of text and of each): every text with
    that of the next key, the last one with that of the first. ``derive`` adds the columns
    ``derived`` to rows with a text; each text is derived from once and handed on. Rows of
    equal keys follow each other by the hash of their text, a null key comes first of all.

    The order is cut into stretches of about equal numbers of rows, each sorted by a task of
    its own, also inside a key and inside the copies of a text under one key; the first row
    of each stretch is handed to the one before it that holds rows."""
    values = ["text", *derived]
    rows = docs.select(column(key).alias("key"), F.coalesce(column(text), F.lit("")).alias("text"))
    rows = rows.withColumns(
        {"hash": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())}
    )
    cuts = _cuts(rows.select("key", "hash", "salt"))
    placed = rows.withColumn("stretch", _stretch(cuts, rows.schema["key"].dataType))
    inside = Window.partitionBy("stretch").orderBy(F.col("key").asc_nulls_first(), "hash", "text", "salt")
    value = F.struct(*values)
    led = derive(placed).withColumn("following", F.lead(value).over(inside))
    order = F.struct(F.col("key").isNotNull().alias("known"), "key", "hash", "text")
    first = materialize(placed.groupBy("stretch").agg(F.min(order).alias("first")), "first-rows")
    # A number for each stretch that holds rows: few enough for one task.
    along = Window.orderBy("stretch")
    givers = first.select("stretch").withColumn("to", F.lag("stretch").over(along))
    lowest = first.agg(F.max("stretch")).scalar()
    givers = givers.withColumn("to", F.coalesce("to", lowest))
    handed = first.join(givers, "stretch").select(F.col("to").alias("stretch"), F.col("first.text").alias("text"))
    handed = derive(handed).select("stretch", value.alias("handed"))
    joined = led.join(handed, "stretch", "left").withColumn("following", F.coalesce("following", "handed"))
    named = [F.col("following")[c].alias(f"next_{c}") for c in values]
    return joined.select(F.col("key").alias(key), *values, *named)
