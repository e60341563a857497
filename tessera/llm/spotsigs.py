"""SpotSigs fingerprints with DataFrame functions only.

Every occurrence of a common word (an anchor) starts a chain of the content words that follow
it; the hashed chains are the signatures of a text. Two texts are alike as their signature sets
overlap. Sets whose sizes differ too much cannot be alike, so pairs are sought between sets of
the same or neighbouring size classes only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has in is it of on or that the this to was with "
    "als auch auf aus bei das dem den der des die ein eine für im ist mit nicht sich sie und von zu zum zur "
    "au aux avec ce ces dans de du elle en est et il la le les ne par pas pour que qui sur un une "
    "al como con del el es esta lo los las más no para pero por se sin su sus una y"
).split()
ANCHORS = tuple(dict.fromkeys(ANCHORS))
#: Content words in a chain, and words after the anchor among which they are sought.
CHAIN, REACH = 2, 8
#: Words are runs of digits, ASCII letters and everything outside ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words for each anchored chain, at most, in a text that anchors can stand for.
SPARSE = 20
#: Code points for each word, at least, in a text that is written without spaces.
UNSPACED = 24
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _signature(a: Column, b: Column, c: Column) -> Column:
    return F.substring(F.md5(F.concat(a, F.lit(":"), b, F.lit(" "), c)), 1, 8)


def _anchored(words: Column) -> Column:
    """Hashed chains of the anchors in the words.

    The content words behind the r-th anchor, at place i, begin at the (i - r)-th content word, so
    one look at each word tells all chains.
    """
    place = F.sequence(F.lit(0), F.size(words) - 1)
    anchors = F.filter(place, lambda i: F.get(words, i).isin(*ANCHORS))
    content = F.filter(place, lambda i: ~F.get(words, i).isin(*ANCHORS))

    def chain(both: Column) -> Column:
        def one(i: Column, r: Column) -> Column:
            first, second = F.get(both["c"], i - r), F.get(both["c"], i - r + 1)
            return F.when(second - i <= REACH, _signature(F.get(words, i), F.get(words, first), F.get(words, second)))

        return F.filter(F.transform(both["a"], one), lambda s: s.isNotNull())

    # the places are found once for all chains
    return F.get(F.transform(F.array(F.struct(anchors.alias("a"), content.alias("c"))), chain), 0)


def _unanchored(words: Column) -> Column:
    """Hashed chains of every word and the two after it."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: _signature(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the fingerprint of a text column: its sorted distinct signatures, joined by spaces.

    A text with fewer anchored chains than one in SPARSE words (another language than the anchors')
    has the chains of all its words instead; in a text written without spaces every character is a
    word. One of fewer than three words has the hash of its whole text. Null counts as empty. Equal
    texts have equal fingerprints, which depend on nothing else.
    """
    words, sigs = f"{out}_words", f"{out}_sigs"
    body = F.coalesce(F.col(text), F.lit(""))
    lower = F.translate(body, _UPPER, _LOWER)
    df = df.withColumn(words, F.array_remove(F.split(lower, BETWEEN), ""))
    single = F.array_remove(F.split(F.regexp_replace(lower, BETWEEN, ""), ""), "")
    df = df.withColumn(words, F.when(F.length(body) >= UNSPACED * F.greatest(F.size(words), F.lit(1)), single).otherwise(F.col(words)))
    df = df.withColumn(sigs, F.when(F.size(words) > CHAIN, _anchored(F.col(words))).otherwise(F.array().cast("array<string>")))
    whole = F.array(F.substring(F.md5(body), 1, 8))
    chosen = F.when((F.size(sigs) > 0) & (F.size(sigs) * SPARSE >= F.size(words)), F.col(sigs)).when(F.size(words) > CHAIN, _unanchored(F.col(words))).otherwise(whole)
    return df.withColumn(out, F.array_join(F.array_sort(F.array_distinct(chosen)), " ")).drop(words, sigs)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints, 0 to 1; null if one is null."""
    x, y = F.split(a, " "), F.split(b, " ")
    both = F.size(F.array_intersect(x, y))
    return F.when(a == b, F.lit(1.0)).otherwise(both / (F.size(x) + F.size(y) - both))


def similar_pairs(prints: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, likeness) of ids with likeness of at least the threshold; prints has id and fingerprint.

    Equal fingerprints are one set, standing for the smallest of their ids. Sets are partitioned
    by size, each into its own class and the next one; the rarest signatures of a set, as many as
    one of its partners must share, are joined, and a pair is kept from the place of a common
    signature only if what is left after it can still reach the threshold.
    """
    step = -math.log(threshold)
    sets = prints.groupBy("fingerprint").agg(F.min("id").alias("id")).withColumn("s", F.split("fingerprint", " "))
    sets = written(sets.select("id", "s", F.size("s").alias("n")), "spots")
    each = sets.select("id", "n", F.explode("s").alias("g"))
    often = each.groupBy("g").agg(F.count("*").alias("f"))
    placed = each.join(often, "g").withColumn("p", F.row_number().over(Window.partitionBy("id").orderBy("f", "g")))
    placed = placed.filter(F.col("n") - F.col("p") + 1 >= F.ceil(F.lit(threshold) * F.col("n")))
    size_class = F.floor(F.log("n") / step)
    left = placed.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"), "g", F.explode(F.array(size_class, size_class + 1)).alias("k"))
    right = placed.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"), "g", size_class.alias("k"))
    need = threshold / (1 + threshold)
    fits = ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & (1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= need * (F.col("na") + F.col("nb")) - 1e-9)
    pairs = left.join(right, ["g", "k"]).filter(fits).select("a", "b").distinct()
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(c), F.col("s").alias(f"s{c}")), c)
    both = F.size(F.array_intersect("sa", "sb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (both / (F.size("sa") + F.size("sb") - both)).alias("likeness"))
    return pairs.filter(F.col("likeness") >= threshold)


def similar_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75) -> DataFrame:
    """doc_id, class_id, n_links of every row: the least id with the same fingerprint, and how many other classes are alike.

    Rows without an id have no class and no links.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = written(with_fingerprint(base, "text", "fingerprint").select("id", "fingerprint"), "prints")
    named = prints.filter("id is not null")
    pairs = similar_pairs(named, threshold)
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").cast("long").alias("n_links"))
    classes = named.groupBy("fingerprint").agg(F.min("id").alias("class_id")).join(links, "class_id", "left")
    found = named.join(classes, "fingerprint").select(F.col("id").alias("doc_id"), "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    none = F.lit(None).cast(base.schema["id"].dataType)
    return found.unionByName(prints.filter("id is null").select(F.col("id").alias("doc_id"), none.alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def with_next(docs: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint) for docs (doc_id, text) in ascending doc_id, the first after the last.

    Ids are cut into blocks of like size at approximate quantiles. Each block is ordered on its
    own, with the first row of the next block as a guest at its end; only the borders and the
    first ids of the blocks, one number each, pass through the driver. Rows without an id have no
    next document and are spread by their text.
    """
    n = max(2, min(blocks, 4000))
    found = docs.select(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n).alias("q")).first()["q"] or []
    cuts = sorted(set(found))
    width = max(1, math.isqrt(len(cuts)))
    coarse, fine = cuts[::width], [cuts[i : i + width] for i in range(0, len(cuts), width)]
    if cuts:
        at = F.size(F.filter(F.lit(coarse), lambda c: c <= F.col("doc_id")))
        within = F.size(F.filter(F.get(F.lit(fine), F.col("at") - 1), lambda c: c <= F.col("doc_id")))
        block = F.when(F.col("at") == 0, F.lit(0)).otherwise((F.col("at") - 1) * width + within)
    else:
        at, block = F.lit(0), F.lit(0)
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")
    rows = docs.withColumn("at", at).withColumn("block", F.when(F.col("doc_id").isNull(), spread).otherwise(block.cast("int"))).drop("at")
    firsts = sorted((r.block, r.first) for r in rows.filter("block >= 0").groupBy("block").agg(F.min("doc_id").alias("first")).collect())
    if firsts:
        before = [firsts[0][0]] * (n + 1)
        for k, (b, _) in enumerate(firsts):
            before[b] = firsts[k - 1][0]
        guest = F.struct(F.get(F.lit(before), F.col("block")).alias("block"), (F.col("block") == firsts[0][0]).alias("wraps"), F.lit(True).alias("guest"))
        own = F.struct(F.col("block"), F.lit(False).alias("wraps"), F.lit(False).alias("guest"))
        places = F.when(F.col("doc_id").isin([f for _, f in firsts]), F.array(own, guest)).otherwise(F.array(own))
    else:
        places = F.array(F.struct(F.col("block"), F.lit(False).alias("wraps"), F.lit(False).alias("guest")))
    rows = rows.withColumn("place", F.explode(places)).select("doc_id", "text", "place.*").repartition("block")
    rows = with_fingerprint(rows, "text", "fingerprint")
    order = Window.partitionBy("block").orderBy("wraps", F.col("doc_id").asc_nulls_last(), "text")
    ahead = {c: F.when(F.col("doc_id").isNotNull(), F.lead(c).over(order)) for c in ("text", "fingerprint")}
    rows = rows.withColumns({f"next_{c}": x for c, x in ahead.items()})
    return rows.filter(~F.col("guest")).drop("guest", "wraps", "block")


def edited_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", blocks: int = 64) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with their likenesses.

    The edited text has the last floor(n/2) code points replaced by the first as many of the next
    document by ascending id. Null texts are empty. A row without an id has an empty next text. Of
    rows with one id, those with the smaller text come first.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(base, blocks).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    nxt = F.coalesce("next_text", F.lit(""))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring(nxt, F.lit(1), half)))
    rows = with_fingerprint(rows.drop("text", "next_text"), "edited", "edited_fingerprint")
    empty = F.substring(F.md5(F.lit("")), 1, 8)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_fingerprint", empty)).alias("near_next"),
    )
