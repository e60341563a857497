"""Records and links as rules over the rows of one parse (see parts.PARTS): built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions import fields as fl
from tessera.functions.keys import linked_dois, named_date

from .parts import Shape

#: What of experiment packages and projects becomes rows.
PACKAGE = Shape(wanted=("EXPERIMENT", "STUDY", "SAMPLE", "RUN", "EXTERNAL_ID", "SUBMISSION"), texts=("STUDY", "SAMPLE", "RUN"), whole=("EXPERIMENT",), bare=("EXPERIMENT_PACKAGE",), head="EXPERIMENT", lend=(("STUDY", "SUBMISSION", "center_name"),))
PROJECT = Shape(wanted=("ArchiveID", "Link", "Publication"), texts=("Package",), head="ArchiveID")
SAMPLE = Shape(texts=("BioSample",))

# Record types by the tag or entity of their part.
TYPES = {
    "EXPERIMENT": "SRA experiment",
    "STUDY": "SRA study",
    "SAMPLE": "SRA sample",
    "RUN": "SRA run",
}
SOFT_TYPES = {
    "SERIES": "GEO Series",
    "SAMPLE": "GEO Sample",
    "PLATFORM": "GEO Platform",
}
# Relation lines by label: relation, whether the record is the near end, how the far end is written.
RELATION_LINES = {
    "SuperSeries of": ("SuperSeries of", True, "word"),
    "SubSeries of": ("SuperSeries of", False, "word"),
    "Reanalyzed by": ("Reanalyzed by", True, "word"),
    "Reanalysis of": ("Reanalyzed by", False, "word"),
    "BioProject": ("BioProject", True, "address"),
    "BioSample": ("BioSample", True, "address"),
    "SRA": ("SRA", True, "address"),
    "Named Annotation": ("Named Annotation", True, "word"),
}
# Other lines that state links, by name: relation, and whether the record is the near end.
LINK_LINES = {
    "Series_sample_id": ("sample", True),
    "Sample_series_id": ("sample", False),
    "Series_platform_id": ("platform", True),
    "Sample_platform_id": ("platform", True),
    "Series_pubmed_id": ("PubMed", True),
    "Sample_pubmed_id": ("PubMed", True),
    "Platform_pubmed_id": ("PubMed", True),
}
DOI_LINES = ("Series_web_link", "Series_citation")
# The relation of link replies by target database.
REPLY_RELATIONS = {
    "sra": "SRA",
    "bioproject": "BioProject",
}
#: All relations that a rule gives; another label of a relation line is kept as it stands.
RELATIONS = {r for r, _, _ in RELATION_LINES.values()} | {r for r, _ in LINK_LINES.values()} | {"DOI", "SRA sample", "study", "run", "umbrella of"}

_DATES = ("submitted", "updated", "published")


def _day(text: Column) -> Column:
    return F.nullif(F.substring(text, 1, 10), F.lit("")).cast("date")


def _first_end(fields: Column, tail: str) -> Column:
    """First value of a path that ends so; null without one."""
    return F.get(F.filter(fields, lambda f: f["name"].endswith(tail)), 0)["value"]


def _records(parts: DataFrame, kind: Column, status: Column, days: tuple[Column, Column, Column]) -> DataFrame:
    return parts.select("origin", "n", "accession", kind.alias("type"), status.alias("status"), *(d.alias(c) for d, c in zip(days, _DATES, strict=True)), "fields", "raw_text", "content_hash")


def _named(types: dict[str, str], tag: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in types.items() for x in pair))[tag]


def package_records(parts: DataFrame) -> DataFrame:
    """Records of packages: the experiment's text is its whole package; their dates come from elsewhere."""
    none = F.lit(None)
    return _records(parts.filter(F.col("tag").isin(*TYPES)), _named(TYPES, F.col("tag")), none.cast("string"), (none.cast("date"),) * 3)


def project_records(parts: DataFrame) -> DataFrame:
    f = F.col("fields")
    at = "Package/Project/Submission"
    days = (_day(fl.first_of(f, f"{at}@submitted")), _day(fl.first_of(f, f"{at}@last_update")), _day(_first_end(f, "/ProjectReleaseDate")))
    return _records(parts.filter("tag = 'Package'"), F.lit("BioProject"), fl.first_of(f, f"{at}/Description/Access"), days)


def sample_records(parts: DataFrame) -> DataFrame:
    f = F.col("fields")
    days = tuple(_day(fl.first_of(f, f"BioSample@{name}")) for name in ("submission_date", "last_update", "publication_date"))
    return _records(parts.filter("tag = 'BioSample'"), F.lit("BioSample"), fl.first_of(f, "BioSample/Status@status"), days)


def soft_records(parts: DataFrame) -> DataFrame:
    """Series, samples and platforms of line-tagged texts; other entities are none. A status line holds the status and the day of release."""
    f, tag = F.col("fields"), F.col("tag")
    # names are literals of each tag, so that none is made anew for every field
    line = lambda name: F.coalesce(*(F.when(tag == t, fl.first_of(f, f"{t.capitalize()}{name}")) for t in SOFT_TYPES))
    lines = parts.filter(tag.isin(*SOFT_TYPES)).select("*", *(line(n).alias(n) for n in ("_status", "_submission_date", "_last_update_date")))
    days = tuple(named_date(F.col(n)) for n in ("_submission_date", "_last_update_date", "_status"))
    return _records(lines, _named(SOFT_TYPES, tag), F.nullif(F.regexp_replace("_status", r"(?s) on .*$", ""), F.lit("")), days)


def _links(rows: DataFrame, a: Column, b: Column, relation: Column | str, source: Column | str) -> DataFrame:
    plain = lambda c: F.lit(c) if isinstance(c, str) else c
    return rows.select(a.alias("from"), b.alias("to"), plain(relation).alias("relation"), plain(source).alias("source"))


def package_links(parts: DataFrame, source: str = "SRA XML") -> DataFrame:
    """(from, to, relation, source) that packages state: study, sample and runs of an experiment, the project of a study, the sample behind a sample."""
    f, tag = F.col("fields"), F.col("tag")
    link = lambda a, b, relation: F.struct(a.alias("from"), b.alias("to"), relation.alias("relation"))
    own, owner, named = F.col("accession"), F.col("owner"), F.lit
    space = fl.first_of(f, "EXTERNAL_ID@namespace")
    outside = ((F.col("within") == "STUDY") & (space == "BioProject")) | ((F.col("within") == "SAMPLE") & (space == "BioSample"))
    # each part states links of its own tag, so one pass over a parse gives all
    each = (
        F.when(tag == "EXPERIMENT", F.array(link(own, fl.first_of(f, "EXPERIMENT/STUDY_REF@accession"), named("study")), link(own, fl.first_of(f, "EXPERIMENT/DESIGN/SAMPLE_DESCRIPTOR@accession"), named("SRA sample"))))
        .when(tag == "RUN", F.array(link(owner, own, named("run"))))
        .when(outside, F.array(link(owner, F.trim(fl.first_of(f, "EXTERNAL_ID")), space)))
    )
    rows = parts.filter(tag.isin("EXPERIMENT", "RUN", "EXTERNAL_ID")).select(F.explode(each).alias("l")).select("l.*", F.lit(source).alias("source"))
    return rows.filter(F.coalesce(F.col("to"), F.lit("")) != "")


def project_links(parts: DataFrame, source: str = "BioProject XML") -> DataFrame:
    """Umbrellas, PubMed and DOI links of projects."""
    f = F.col("fields")
    top = parts.filter("tag = 'Link'").filter(fl.first_of(f, "Link/Hierarchical@type") == "TopAdmin")
    papers = parts.filter("tag = 'Publication'").select("owner", fl.first_of(f, "Publication@id").alias("id"), fl.first_of(f, "Publication/DbType").alias("db")).filter("id <> ''")
    dois = papers.filter("db = 'eDOI'").select("owner", F.explode(linked_dois(F.col("id"))).alias("doi"))
    each = [
        _links(top, fl.first_of(f, "Link/Hierarchical/MemberID@accession"), fl.first_of(f, "Link/ProjectIDRef@accession"), "umbrella of", source),
        _links(papers.filter("db = 'ePubmed'"), F.col("owner"), F.concat(F.lit("PMID:"), "id"), "PubMed", source),
        _links(dois, F.col("owner"), F.concat(F.lit("DOI:"), "doi"), "DOI", source),
    ]
    return reduce(DataFrame.union, each).filter('"from" is not null and "to" is not null'.replace('"', "`"))


def soft_links(parts: DataFrame, source: str = "SOFT") -> DataFrame:
    """Links that series, samples and platforms state in their lines. A relation line without a far end raises.

    A label that no rule knows keeps its own name, forward, with what follows it.
    """
    name, value = F.col("name"), F.col("value")
    stating = name.endswith("_relation") | name.isin(*LINK_LINES, *DOI_LINES)
    lines = parts.filter(F.col("tag").isin(*SOFT_TYPES)).select("accession", F.explode("fields").alias("f")).select("accession", "f.name", "f.value").filter(stating)
    # each line is of one form, so one pass over a parse gives all links
    known = F.create_map(*(x for k, (r, near, form) in RELATION_LINES.items() for x in (F.lit(k), F.struct(F.lit(r).alias("relation"), F.lit(near).alias("near"), F.lit(form).alias("form")))))
    plain = F.create_map(*(x for k, (r, near) in LINK_LINES.items() for x in (F.lit(k), F.struct(F.lit(r).alias("relation"), F.lit(near).alias("near"), F.lit("plain").alias("form")))))
    label = F.substring_index("value", ": ", 1)
    rest = F.when(F.instr("value", ": ") > 0, F.expr("substring(value, instr(value, ': ') + 2)")).otherwise("")
    listed = name.isin(*LINK_LINES)
    rows = lines.withColumn("label", label).withColumn("rest", rest).withColumn("rule", F.when(listed, plain[name]).otherwise(known[F.col("label")]))
    # an accession at the end of an address: behind a slash, or the value of a term
    ending = F.regexp_extract(F.rtrim("rest"), r"[/=]([A-Z]+[0-9]+)$", 1)
    address = F.when(F.rtrim("rest").rlike(r"(/|term=)[A-Z]+[0-9]+$"), ending).otherwise("")
    far = F.when(F.col("rule").isNull(), F.trim("rest")).when(F.col("rule.form") == "address", address).otherwise(F.trim(F.substring_index("rest", " ", 1)))
    paper = F.when(F.col("rule.relation") == "PubMed", F.concat(F.lit("PMID:"), value)).otherwise(value)
    said = F.raise_error(F.concat(F.col("accession"), F.lit(": no far end in "), "name", F.lit(" = "), "value"))
    rows = rows.withColumn("far", F.when(listed, paper).when(name.endswith("_relation"), far))
    rows = rows.withColumn("far", F.when(~listed & (F.col("far") == ""), said).otherwise(F.col("far")))
    near = F.coalesce("rule.near", F.lit(True))
    link = lambda a, b, r, s: F.struct(a.alias("from"), b.alias("to"), r.alias("relation"), s.alias("source"))
    own = F.array(link(F.when(near, F.col("accession")).otherwise(F.col("far")), F.when(near, F.col("far")).otherwise(F.col("accession")), F.coalesce("rule.relation", "label"), F.lit(source)))
    dois = F.transform(linked_dois(value), lambda d: link(F.col("accession"), F.concat(F.lit("DOI:"), d), F.lit("DOI"), F.concat(F.lit(f"{source} "), name)))
    return rows.select(F.explode(F.when(name.isin(*DOI_LINES), dois).otherwise(own)).alias("l")).select("l.*")


def reply_links(replies: DataFrame, source: str = "Entrez link") -> DataFrame:
    """Links of link replies (accession, raw_text), lines of from, database, uid and target; a line without a target states none.

    A line of other than four cells, or of a database that no rule knows, raises.
    """
    lines = replies.select(F.explode(F.split("raw_text", r"\r?\n")).alias("line")).filter("line <> ''").select("line", F.split("line", "\t").alias("c"))
    relation = _named(REPLY_RELATIONS, F.get("c", 1))
    said = F.raise_error(F.concat(F.lit("not a link line: "), "line"))
    rows = lines.select(F.get("c", 0).alias("a"), F.get("c", 3).alias("b"), F.when((F.size("c") != 4) | relation.isNull(), said).otherwise(relation).alias("r"))
    return _links(rows.filter("r is not null and b <> ''"), F.col("a"), F.col("b"), F.col("r"), source)


def paper_links(replies: DataFrame, source: str = "PubMed") -> DataFrame:
    """PubMed links of search replies (accession, raw_text): each number between white space is a paper."""
    numbers = F.filter(F.split("raw_text", r"\s+"), lambda x: x.rlike(r"^[0-9]+$"))
    return _links(replies.select("accession", F.explode(numbers).alias("id")), F.col("accession"), F.concat(F.lit("PMID:"), "id"), "PubMed", source)


def summary_links(targets: DataFrame, source: str = "GEO summary") -> DataFrame:
    """The project of each target series (accession, bioproject) as its listing has it."""
    return _links(targets.filter("bioproject <> ''"), F.col("accession"), F.col("bioproject"), "BioProject", source)


def named_files(records: DataFrame) -> DataFrame:
    """(owner, name, url): supplementary files that the lines of series, samples and platforms name; NONE is none."""
    lines = records.filter(F.col("type").isin(*SOFT_TYPES.values())).select("accession", F.explode("fields").alias("f"))
    url = F.trim(F.regexp_replace("f.value", r"^\s+|\s+$", ""))
    rows = lines.filter(F.col("f.name").rlike(r"^(Series|Sample|Platform)_supplementary_file(_[0-9]+)?$")).select(F.col("accession").alias("owner"), url.alias("url"))
    return rows.filter("url <> '' and url <> 'NONE'").distinct().select("owner", F.substring_index("url", "/", -1).alias("name"), "url")


def listed_files(listings: DataFrame) -> DataFrame:
    """(owner, name, size, date, type, archive) of file listings (accession, raw_text): a line's archive is the one above it.

    Of files of one name the entry of the lowest-numbered owner counts. A listing is cut before each line of an archive, so that the
    archive above is the first line of its piece and a listing stays in its row.
    """
    pieces = listings.select("accession", F.posexplode(F.split("raw_text", r"\r?\n(?=Archive\t(?:[^\t\n]*\t){3})")).alias("piece", "text"))
    cells = lambda line: F.split(line, "\t")
    first = cells(F.substring_index("text", "\n", 1))
    # lines of less than five cells are no entries
    above = F.when(F.col("text").startswith("Archive\t") & (F.size(first) >= 5), F.get(first, 1))
    rows = pieces.select("accession", "piece", above.alias("above"), F.posexplode(F.split("text", r"\r?\n")).alias("n", "line")).filter(~F.col("line").startswith("#")).withColumn("c", cells(F.col("line"))).filter(F.size("c") >= 5)
    entry = F.struct(F.col("accession").alias("owner"), F.get("c", 3).cast("long").alias("size"), F.to_timestamp_ntz(F.get("c", 2), F.lit("MM/dd/yyyy HH:mm:ss")).alias("date"), F.get("c", 4).alias("type"), F.when(F.get("c", 0) != "Archive", F.col("above")).alias("archive"))
    rows = rows.select(F.get("c", 1).alias("name"), entry.alias("e"), "piece", "n")
    number = F.regexp_extract("e.owner", r"([0-9]+)$", 1).try_cast("long")
    # within one listing a name given again replaces the one before
    last = rows.groupBy("name", "e.owner").agg(F.max_by("e", F.struct("piece", "n")).alias("e"))
    return last.groupBy("name").agg(F.min_by("e", F.struct(F.coalesce(number, F.lit(0).cast("long")), F.col("e.owner"))).alias("e")).select("name", "e.*")


def supplementary(named: DataFrame, listed: DataFrame) -> DataFrame:
    """Named files with what a listing says of them, and listed files that nobody names under the owner of the listing."""
    # one join, so that listings are read once
    found = named.withColumn("_named", F.lit(True)).join(listed.withColumnRenamed("owner", "_owner"), "name", "full")
    return found.select("name", F.when(F.col("_named"), F.col("owner")).otherwise(F.col("_owner")).alias("owner"), "url", "size", "date", "type", "archive")


def kept_rank(newest: Column) -> Column:
    """Order of a record's copies: newest first where that holds, then the lowest number and text of their origin, then place."""
    number = F.coalesce(F.regexp_extract("origin", r"([0-9]+)$", 1).try_cast("long"), F.lit(0).cast("long"))
    age = F.when(newest, -F.unix_date("updated")).otherwise(0)
    return F.struct(age.alias("age"), number.alias("number"), F.col("origin").alias("origin"), F.col("n").alias("n"))


def record_keys(records: DataFrame) -> DataFrame:
    """(type, accession, copies): each record once, with the number of its copies."""
    return records.groupBy("type", "accession").agg(F.count("*").alias("copies"))


def repeated_types(keys: DataFrame) -> list[str]:
    """Types of which some record has more than one copy, by the keys of records."""
    return sorted(r["type"] for r in keys.groupBy("type").agg(F.max("copies").alias("copies")).filter("copies > 1").select("type").collect())


def kept_records(records: DataFrame, newest: str = SOFT_TYPES["SAMPLE"], count: str | None = None) -> DataFrame:
    """records with one copy each: the least by kept_rank; of the type newest the latest, where all copies have a date. A column count, if named, tells how many there are.

    Minima only, so a study that stands in all its packages sends one row from each task, and texts are shuffled once.
    """
    values = [c for c in records.columns if c not in ("accession", "type", "n")]
    row, latest = F.struct(*values), F.col("type") == newest
    first = F.min_by(row, kept_rank(F.lit(False))).alias("plain")
    last = F.min_by(F.when(latest, row), F.when(latest, kept_rank(F.lit(True)))).alias("late")
    copies = records.groupBy("type", "accession").agg(first, last, F.count_if(F.col("updated").isNull()).alias("undated"), *([F.count("*").alias("_copies")] if count else []))
    kept = F.when(latest & (F.col("undated") == 0), F.col("late")).otherwise(F.col("plain"))
    told = [F.col("_copies").alias(count)] if count else []
    return copies.select("type", "accession", kept.alias("r"), *told).select("type", "accession", *(F.col(f"r.{c}").alias(c) for c in ("content_hash", *(v for v in values if v != "content_hash"))), *([count] if count else []))


#: Records of differing copies up to this many go to all tasks; more are joined by a shuffle.
FEW_RECORDS = 100_000


def differing_copies(records: DataFrame, newest: str = SOFT_TYPES["SAMPLE"]) -> DataFrame:
    """(accession, detail) of records whose copies differ: the origin kept, how many other copies, the first of them, and the names of the fields that differ.

    Texts are told apart by their hash; all else is read only of records with more than one.
    """
    from tessera.sources.scratch import cut

    record = ["type", "accession"]
    digest = F.unhex("content_hash")
    # one row a record and task; the fields of most records are never shuffled
    several = cut(records.groupBy(*record).agg((F.min(digest) != F.max(digest)).alias("_differ")).filter("_differ").select(*record))
    few = several.limit(FEW_RECORDS + 1).count() <= FEW_RECORDS
    copies = records.join(F.broadcast(several) if few else several, record, "left_semi")
    own = F.min_by("fields", F.struct("origin", "n")).alias("fields")
    contents = cut(copies.groupBy(*record, "content_hash").agg(F.min(kept_rank(F.lit(False))).alias("plain"), F.min(kept_rank(F.lit(True))).alias("late"), F.count("*").alias("count"), F.count_if(F.col("updated").isNull()).alias("undated"), own))
    undated = contents.groupBy(*record).agg(F.sum("undated").alias("_undated"))
    at = F.when((F.col("type") == newest) & (F.col("_undated") == 0), F.col("late")).otherwise(F.col("plain"))
    each = contents.join(undated, record).select(*record, at.alias("at"), F.col("count").alias("n"), "fields")
    best = each.groupBy(*record).agg(F.min("at").alias("kept"), F.min_by("fields", "at").alias("own"))
    others = each.join(best, record).filter("at <> kept").select(*record, "kept", "at", "n", F.explode_outer(fl.differing_names(F.col("fields"), F.col("own"))).alias("name"))
    per = others.groupBy("type", "accession", "kept", "at").agg(F.max("n").alias("n"), F.collect_set("name").alias("names"))
    found = per.groupBy("type", "accession", "kept").agg(F.sum("n").alias("n"), F.min("at").alias("first"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    names = F.when(F.size("names") > 0, F.array_join("names", ", ")).otherwise("text only")
    return found.select("accession", F.format_string("kept %s; %d other copies, first %s, differ in: %s", "kept.origin", "n", "first.origin", names).alias("detail"))


def unknown_labels(links: DataFrame, source: str = "SOFT") -> DataFrame:
    """(accession, detail): each relation of the source that no rule knows, with an example and the number of its links."""
    rows = links.filter((F.col("source") == source) & ~F.col("relation").isin(*sorted(RELATIONS)))
    return rows.groupBy("relation").agg(F.min("from").alias("accession"), F.count("*").alias("n")).select("accession", F.format_string("%s: %d links", "relation", "n").alias("detail"))
