"""Files of papers as their marked-up text names them: supplements, figures and inline images, with labels and captions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .parts import Part, Shape, xml_parts

#: Containers of files, what is said of them, and the files themselves; any element in a supplement may name one.
ARTICLE = Shape(wanted=("fig", "table-wrap", "supplementary-material", "label", "caption", "graphic", "inline-graphic"), plain=("label", "caption"), bare=("label", "caption"))
# Endings of images and of videos.
IMAGES = ("jpg", "jpeg", "gif", "png", "tif", "tiff", "bmp", "eps", "svg", "webp")
VIDEOS = ("mp4", "mov", "avi", "wmv", "mpg", "mpeg", "m4v", "webm", "mkv", "flv")
_HREF = "@xlink:href"
_SPACE = re.compile(r"[ \t\n\x0B\f\r]+")


def stem(name: Column) -> Column:
    """A file's name without its last ending."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def ending(name: Column) -> Column:
    """The last ending in lower case; empty without one, and for a name that only begins with a point."""
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]*)$", 1))


def safe_name(name: Column) -> Column:
    """True for a name that leads to no other folder and is not hidden."""
    return ~name.contains("/") & ~name.contains("\\") & ~name.startswith(".")


def is_video(name: Column) -> Column:
    return ending(name).isin(*VIDEOS)


def named_files(papers: DataFrame) -> DataFrame:
    """(paper, kind, href, label, caption) of the files that papers (paper, raw_text) name; kind is supplement, figure or inline.

    A container's label and caption are those that stand right in it, white space made single; an inner container's come
    before an outer one's. A supplement named in several containers has all of their labels and captions, in order. A file that
    is a supplement is nothing else, and a figure no inline image. A text that is no XML names none.
    """
    rows = papers.select(F.col("paper").cast("string").alias("paper"), F.col("raw_text").cast("string").alias("raw_text")).mapInArrow(_named_in, "paper string, n int, kind string, href string, label string, caption string")
    kind = F.col("kind")
    joined = lambda c: F.nullif(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when((kind == "box") & F.col(c).isNotNull(), F.struct("n", F.col(c).alias("t"))))), lambda s: s["t"])), "; "), F.lit("")).alias(c)
    inner = F.max_by(F.when(kind == "inner", F.struct("label", "caption")), F.when(kind == "inner", F.col("n"))).alias("x")
    each = rows.groupBy("paper", "href").agg(joined("label"), joined("caption"), inner, F.collect_set("kind").alias("kinds"))
    none = F.lit(None).cast("string")
    has = lambda k: F.array_contains("kinds", k)
    named = lambda k, label, caption: F.struct(F.lit(k).alias("kind"), label.alias("label"), caption.alias("caption"))
    shown = F.filter(F.array(F.when(has("graphic"), named("figure", F.col("x.label"), F.col("x.caption"))), F.when(has("inline-graphic"), named("inline", none, none))), lambda m: m.isNotNull())
    meant = F.when(has("box"), F.array(named("supplement", F.col("label"), F.col("caption")))).otherwise(shown)
    return each.select("paper", "href", F.explode(meant).alias("m")).select("paper", "m.kind", "href", "m.label", "m.caption")


_NAMED = pa.schema([("paper", pa.string()), ("n", pa.int32()), ("kind", pa.string()), ("href", pa.string()), ("label", pa.string()), ("caption", pa.string())])
_BOXES = ("fig", "table-wrap", "supplementary-material")


def _names_of(text: str | None) -> Iterator[tuple[int, str, str, str | None, str | None]]:
    """(n, kind, href, label, caption) of what a text names: by a supplement (box), by another container (inner), and by images."""
    try:
        found = xml_parts(text, ARTICLE) if text else []
    except expat.ExpatError:
        return
    # a label or caption that stands right in a container follows it, before the next container of its tag; the last one counts
    said: dict[str, dict[str, str]] = {}
    at: list[tuple[int, Part, dict[str, str]]] = []
    for n, part in enumerate(found):
        if part.tag in _BOXES:
            said[part.tag] = {}
        elif part.tag in ("label", "caption") and part.within in said:
            if plain := _SPACE.sub(" ", part.text or "").strip(" "):
                said[part.within][part.tag] = plain
        if part.tag in _BOXES or part.tag in ("graphic", "inline-graphic"):
            at.append((n, part, said.get(part.tag, {})))
    for n, part, words in at:
        kind = "box" if part.tag == "supplementary-material" else "inner" if part.tag in _BOXES else part.tag
        for name, value in part.fields:
            if name.endswith(_HREF):
                yield n, kind, value.rsplit("/", 1)[-1], words.get("label"), words.get("caption")


def _named_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(paper, *row) for paper, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in _names_of(text)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NAMED, strict=True)], schema=_NAMED)


def chosen_files(listing: DataFrame, named: DataFrame) -> DataFrame:
    """(paper, name, kind, label, caption) of the listed files (paper, name, size) to keep: supplements, and of each figure's images the largest.

    A file is meant by its whole name or its name without ending. It is a supplement if the text names it so, or if it is
    neither an inline image nor an image at all; unsafe names are left out. One equi-join, by name or stem.
    """
    files = listing.filter(safe_name(F.col("name"))).groupBy("paper", "name").agg(F.max("size").alias("size")).withColumn("stem", stem(F.col("name")))
    way = lambda form, key, rank: F.struct(F.lit(form).alias("form"), key.alias("key"), F.lit(rank).alias("rank"))
    ways = F.array(way("whole", F.col("name"), 0), way("whole", F.col("stem"), 1), way("stem", F.col("stem"), 2))
    sought = files.select("paper", "name", "size", F.explode(ways).alias("w")).select("paper", "name", "size", "w.*")
    # a figure is also meant by its own name without ending
    ends = F.concat(F.array(F.struct(F.lit("whole").alias("form"), F.col("href").alias("key"))), F.when(F.col("kind") == "figure", F.array(F.struct(F.lit("stem").alias("form"), stem(F.col("href")).alias("key")))).otherwise(F.array()))
    said = named.select("paper", "kind", "href", "label", "caption", F.explode(ends).alias("e")).select("paper", "kind", "href", "label", "caption", "e.*")
    # estimates go by the size of files, so that names of many papers would be broadcast through the driver
    found = sought.join(said.hint("merge"), ["paper", "form", "key"], "left")
    # what is a supplement by name is nothing else; a file has one meaning of each kind
    of = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.struct("href", "label", "caption")), F.when(F.col("kind") == kind, F.struct("rank", "href"))).alias(kind)
    each = found.groupBy("paper", "name").agg(F.max("size").alias("size"), of("supplement"), of("figure"), of("inline"))
    image, none = ending(F.col("name")).isin(*IMAGES), F.lit(None).cast("string")
    extra, figure = F.col("supplement").isNotNull(), F.col("supplement").isNull() & image & F.col("figure").isNotNull()
    rest = ~image & F.col("supplement").isNull() & F.col("inline").isNull()
    meant = each.filter(extra | figure | rest).select("paper", "name", "size", F.when(figure, "figure").otherwise("supplement").alias("kind"), F.when(figure, F.col("figure.href")).otherwise(F.col("name")).alias("of"), F.when(extra, F.col("supplement.label")).when(figure, F.col("figure.label")).otherwise(none).alias("label"), F.when(extra, F.col("supplement.caption")).when(figure, F.col("figure.caption")).otherwise(none).alias("caption"))
    best = meant.groupBy("paper", "kind", "of").agg(F.max_by(F.struct("name", "label", "caption"), F.struct("size", "name")).alias("b"))
    return best.select("paper", "b.name", "kind", "b.label", "b.caption")
