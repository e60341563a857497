"""Standings, closed copies, work in rounds, seals, and lookups that skip what they need not read."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions import keys
from tessera.operators import paper_files, parts, refresh, rounds, standing
from tessera.sources import seals
from tessera.sources.tables import Versions
from tessera.store import Store, in_ranges, key_ranges

PAPER = "paper string, pmid long, pmcid string, doi string, other_dois array<string>, openalex_pdf boolean, host_links array<string>, published date, status string, reason string, retracted boolean"
ATTEMPT = "paper string, tier string, date date, account string, outcome string"
FILE = "paper string, kind string, name string, path string, tier string"
DAY = dt.date(2024, 6, 1)


def plain_standing(p, attempts, files):
    """The ladder for one paper, rung by rung."""
    held = [f for f in sorted(files, key=lambda f: (f[2], f[4])) if f[1] in ("xml", "pdf") and f[3]]
    tier_of = lambda kind: next((f[4] for f in held if f[1] == kind), None)
    tried = {t: [a[4] for a in sorted(attempts, key=lambda a: (a[2], a[3] or "", a[4])) if a[1] == t] for t in standing.TIERS}

    def at(status, reason, tier):
        return status, reason, tier, tier_of("xml"), tier_of("pdf")

    if p["status"] == "skipped" and p["reason"] in standing.NO_PAPERS:
        return at("skipped", p["reason"], None)
    if p["retracted"]:
        return at("skipped", "retracted", None)
    if held:
        return at("fetched", None, None)
    near = "paperpile"
    if p["host_links"] and not tried["host"]:
        near = "host"
    if p["openalex_pdf"] and "failed" not in tried["openalex"] and tried["openalex"].count("error") < 3:
        near = "openalex"
    if p["pmcid"] and set(tried["pmc"]) <= {"error"} and len(tried["pmc"]) < 3:
        near = "pmc"
    if p["published"] and p["published"] > DAY - dt.timedelta(365):
        return at("waiting", "pmc-embargo", near if near in standing.FREE_TIERS else None)
    if near in standing.WAITS:
        return at("waiting", standing.WAITS[near], near)
    if tried["host"]:
        return at("manual", "host-blocked" if tried["host"][-1] == "blocked" else "host-failed", near)
    return at("manual", "openalex-failed" if tried["openalex"] else "no-route", near)


def test_standings_equal_the_ladder(spark):
    rng = random.Random(4)
    papers, attempts, files = [], [], []
    for k in range(400):
        row = (f"P{k}", k, rng.choice([None, "", "PMC1"]), None, None, rng.choice([None, True, False]), rng.choice([None, [], ["u"]]), rng.choice([None, dt.date(2024, 1, 1), dt.date(2023, 6, 2), dt.date(2023, 6, 3), dt.date(2020, 1, 1)]), rng.choice([None, "skipped", "manual"]), rng.choice([None, "placeholder", "x"]), rng.choice([None, None, False, True]))
        papers.append(row)
        attempts += [(f"P{k}", rng.choice(standing.TIERS), DAY - dt.timedelta(rng.randint(1, 4)), rng.choice([None, "a", "b"]), rng.choice(["error", "error", "failed", "blocked", "empty"])) for _ in range(rng.choice([0, 0, 1, 2, 5]))]
        files += [(f"P{k}", rng.choice(["xml", "pdf", "suppl"]), f"n{rng.randint(0, 3)}", rng.choice(["", None, "a/b"]), rng.choice(standing.TIERS)) for _ in range(rng.choice([0, 0, 0, 1, 2]))]
    names = [f.split()[0] for f in PAPER.split(", ")]
    want = {p[0]: plain_standing(dict(zip(names, p)), [a for a in attempts if a[0] == p[0]], [f for f in files if f[0] == p[0]]) for p in papers}
    got = standing.standings(spark.createDataFrame(papers, PAPER), spark.createDataFrame(attempts, ATTEMPT), spark.createDataFrame(files, FILE), F.lit(DAY))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert len({w[:3] for w in want.values()}) > 10


def test_closed_copy_of_papers(spark):
    none = [None] * 6
    tables = {
        "papers": spark.createDataFrame([("P1", 11, None, "10.1/A", ["10.2/b"], *none), ("P2", 12, None, None, None, *none), ("P3", 13, None, "10.1/c", None, *none)], PAPER),
        "attempts": spark.createDataFrame([("P1", "pmc", DAY, "me", "error"), ("P3", "pmc", DAY, "me", "error")], ATTEMPT),
        "files": spark.createDataFrame([("P1", "xml", "n", "p", "pmc"), ("P2", "xml", "n", "p", "pmc")], FILE),
    }
    links = spark.createDataFrame([("GSE1", "DOI:https://doi.org/10.2/B", "DOI"), ("GSE1", "PMID:12", "PubMed"), ("GSE2", "PMID:13", "PubMed"), ("GSM1", "PMID:13", "PubMed"), ("GSE1", "PMID:99", "PubMed"), ("GSE1", "PMID:13", "sample")], "`from` string, `to` string, relation string")
    held = spark.createDataFrame([("GSE1", "GEO Series"), ("GSM1", "GEO Sample")], "accession string, type string")
    kept, outside = standing.paper_subset(tables, links, held)
    assert {n: sorted(r.paper for r in df.collect()) for n, df in kept.items()} == {"papers": ["P1", "P2"], "attempts": ["P1"], "files": ["P1", "P2"]}
    assert kept["attempts"].first().account is None and [tuple(r) for r in outside.collect()] == [("GSE1", "PMID:99")]
    assert standing.open_ends(kept).count() == 0 and standing.open_ends(tables | {"papers": tables["papers"].filter("paper = 'P1'")}).count() == 2
    empty = {n: df.limit(0) for n, df in tables.items()}
    kept, outside = standing.paper_subset(empty, links, held)
    assert kept["papers"].count() == 0 and outside.count() == 3


def test_confirmations_survive_a_replay(spark, tmp_path):
    asked = rounds.Confirmations(spark, str(tmp_path / "asked"))
    want = spark.createDataFrame([(k,) for k in "abcd"], "accession string")
    say = lambda n, **said: asked.record(n, spark.createDataFrame(list(said.items()), "accession string, state string"))
    state = lambda: {r.accession: (r.state, r.asked, r.settled) for r in asked.states(want).collect()}
    assert state() == {k: ("open", 0, None) for k in "abcd"} and asked.pending(want).count() == 4
    say(1, a="gone", b="failed", c="served")
    before = state()
    say(1, a="gone", b="failed", c="served")
    assert state() == before == {"a": ("gone", 1, 1), "b": ("failed", 1, None), "c": ("served", 1, 1), "d": ("open", 0, None)}
    say(2, a="served", b="gone", c="gone", x="gone")
    assert state() == {"a": ("gone", 2, 1), "b": ("gone", 2, 2), "c": ("served", 2, 1), "d": ("open", 0, None)}
    assert {r.accession for r in asked.removals(want).collect()} == {"a", "b"} and [r.accession for r in asked.pending(want).collect()] == ["d"]
    asked.record(3, spark.createDataFrame([("d", "gone"), ("d", "served")], "accession string, state string"))
    assert state()["d"] == ("served", 1, 3)
    with pytest.raises(PySparkException):
        say(4, a="lost")


def test_breadth_retries_once(spark):
    texts = {"a": "b c", "b": "d", "c": "", "d": "e", "e": "f", "f": "", "g": ""}
    first, second = {"a", "c", "d", "f"}, {"b"}
    calls = []

    def fetch(keys, attempt):
        found = sorted(r.key for r in keys.collect())
        calls.append((attempt, found))
        return spark.createDataFrame([(k, texts[k] if k in (second if attempt else first) else None) for k in found], "key string, raw_text string")

    named = lambda t: t.select(F.explode(F.filter(F.split("raw_text", " "), lambda x: x != "")).alias("next"))
    got = {r.key: (r.round, r.held) for r in rounds.breadth_with_retry(spark.createDataFrame([("a",)], "key string"), fetch, named).collect()}
    assert got == {"a": (0, True), "b": (1, False), "c": (1, True)} | {"b": (1, True), "d": (3, True), "e": (4, False)}
    assert calls == [(0, ["a"]), (0, ["b", "c"]), (1, ["b"]), (0, ["d"]), (0, ["e"])]


def test_seals_find_what_changed(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("x", "y")}
    rows = spark.range(1000).withColumn("v", F.col("id") % 7)
    for p in paths.values():
        rows.repartition(3).write.parquet(p)
    seals.seal(spark, paths).write.parquet(str(tmp_path / "seal"))
    sealed = spark.read.parquet(str(tmp_path / "seal"))
    assert sealed.count() == 6 and seals.broken_seals(spark, sealed, paths).count() == 0
    assert {tuple(r)[:3] for r in seals.inputs_of(sealed).collect()} == {("x", 3, 1000), ("y", 3, 1000)}
    a, b = seals.inputs_of(sealed).collect()
    assert a.checksum == b.checksum  # the same rows, however they lie
    files = sorted(p for p in (tmp_path / "x").iterdir() if p.suffix == ".parquet")
    files[0].unlink()
    files[1].write_bytes(files[2].read_bytes())
    (tmp_path / "x" / f".{files[1].name}.crc").unlink()
    rows.limit(1).write.mode("append").parquet(paths["y"])
    found = sorted((r.table, r.fault) for r in seals.broken_seals(spark, sealed, paths).collect())
    assert len(found) == 3 and ("x", "missing") in found and ("y", "not in the seal") in found
    assert {f for _, f in found} & {"rows differ", "content differs"}


def scanned(df):
    """Rows that the scans of a finished query gave on."""
    df.write.format("noop").mode("overwrite").save()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    df._jdf.collectToPython()
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return rows


def test_lookups_skip_row_groups(spark, tmp_path):
    n = 60_000
    kinds = {f.name: f.dataType for f in schema.RECORDS.schema}
    rows = spark.range(n).select(*(F.format_string("GSM%09d", "id").alias(c) if c == "accession" else F.lit("t").alias(c) if c == "raw_text" else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
    versions = Versions(spark, str(tmp_path))
    versions.write("v", {schema.RECORDS: rows})
    versions.publish("v")
    store = Store(spark, str(tmp_path), "v")
    wanted = [f"gsm{k:09d}" for k in [*range(500), *range(n - 500, n)]]
    found = store.open_many(wanted)
    assert found.count() == 1000 and scanned(found.select("accession")) < 0.1 * n
    assert store.open_many(["GSM000000007", "none", " gsm000000007"]).count() == 1 and store.open_many([]).count() == 0


def test_key_ranges():
    assert key_ranges([]) == [] and key_ranges(["b", "a", "b"], 1) == [("a", "b")] and key_ranges(["a"]) == [("a", "a")]
    keys = [f"A{k}" for k in (1, 2, 3, 900, 901)] + ["Z5"]
    assert key_ranges(keys, 3) == [("A1", "A3"), ("A900", "A901"), ("Z5", "Z5")]
    rng = random.Random(1)
    many = [f"{rng.choice('AB')}{rng.randint(0, 10**6)}" for _ in range(500)]
    found = key_ranges(many, 20)
    assert len(found) <= 20 and all(any(a <= k <= b for a, b in found) for k in many) and all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_ranges_as_a_condition(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert [r.k for r in df.filter(in_ranges(F.col("k"), [("a", "a"), ("c", "d"), ("x", "x")])).collect()] == ["a", "c"]
    assert df.filter(in_ranges(F.col("k"), [])).count() == 0


def test_run_blocks_and_marked_runs(spark):
    text = '<P><RUN accession="SRR1" x="a>b"><Statistics><Read index="1" average="94.5"/><Read index="0" average="28.5"/><Read index="2"/><Read average="3"/></Statistics></RUN><RUN accession="SRR2"/><RUN/></P>'
    rows = spark.createDataFrame([("X1", text), ("X2", "<P>"), ("X3", None), ("X4", text)], "accession string, raw_text string")
    got = {r.accession: (r.raw_text[:26], r.lengths, r.structure) for r in parts.run_blocks(rows).collect()}
    assert got == {"SRR1": ('<RUN accession="SRR1" x="a', [28, 94], "28+94"), "SRR2": ('<RUN accession="SRR2"/>', [], "")}
    marked = spark.createDataFrame([("SRR2",), ("SRR9",), (None,)], "run string")
    assert sorted((r.accession, r.runs) for r in refresh.with_marked_runs(rows, marked).collect()) == [("X1", ["SRR2"]), ("X4", ["SRR2"])]


ARTICLE = """<article xmlns:xlink="x"><supplementary-material id="s"><label>S1</label><caption><p>One <b>b</b>old
 line</p></caption><media xlink:href="http://h/x/a.pdf"><caption>not it</caption></media></supplementary-material><supplementary-material xlink:href="a.pdf"><label>S2</label><caption>Two</caption></supplementary-material>
<fig><label>Fig 1</label><graphic xlink:href="g1.tif"/><fig><label>Fig 1a</label><graphic xlink:href="g2"/></fig></fig><graphic xlink:href="alone"/><inline-graphic xlink:href="i1.gif"/><graphic xlink:href="a.pdf"/></article>"""


def test_files_that_papers_name(spark):
    papers = spark.createDataFrame([("P1", ARTICLE), ("P2", "<article>"), ("P3", None), ("P4", "<article/>")], "paper string, raw_text string")
    named = paper_files.named_files(papers)
    got = {(r.paper, r.kind, r.href): (r.label, r.caption) for r in named.collect()}
    assert got == {("P1", "supplement", "a.pdf"): ("S1; S2", "One bold line; Two"), ("P1", "figure", "g1.tif"): ("Fig 1", None), ("P1", "figure", "g2"): ("Fig 1a", None), ("P1", "figure", "alone"): (None, None), ("P1", "inline", "i1.gif"): (None, None)}
    listed = [("a.pdf", 1), ("g1.jpg", 5), ("g1.gif", 9), ("g2.png", 2), ("alone.jpg", 1), ("i1.gif", 1), ("i1.txt", 1), ("b.doc", 1), ("preview.jpg", 1), ("../x.zip", 1), (".y.zip", 1), ("movie.MP4", 1)]
    listing = spark.createDataFrame([("P1", n, s) for n, s in listed] + [("P4", "z.csv", 1)], "paper string, name string, size long")
    kept = {(r.paper, r.name): (r.kind, r.label) for r in paper_files.chosen_files(listing, named).collect()}
    assert kept == {("P1", "a.pdf"): ("supplement", "S1; S2"), ("P1", "g1.gif"): ("figure", "Fig 1"), ("P1", "g2.png"): ("figure", "Fig 1a"), ("P1", "alone.jpg"): ("figure", None), ("P1", "b.doc"): ("supplement", None), ("P1", "i1.txt"): ("supplement", None), ("P1", "movie.MP4"): ("supplement", None), ("P4", "z.csv"): ("supplement", None)}
    names = spark.createDataFrame([("a.MOV",), ("x/a.b",), (".a",), ("a\\b",), ("a",)], "n string")
    assert [tuple(r) for r in names.select(paper_files.is_video(F.col("n")), paper_files.safe_name(F.col("n"))).collect()] == [(True, True), (False, False), (False, False), (False, False), (False, True)]


def test_conditions_ids_and_folders(spark, tmp_path):
    kinds = {f.name: f.dataType for f in schema.RECORDS.schema}
    rows = spark.createDataFrame([("GSM1", "GEO Sample", "live"), ("GSM2", "GEO Sample", "gone"), ("GSE1", "GEO Series", "live")], "accession string, type string, status string")
    rows = rows.select(*(F.col(c) if c in rows.columns else F.array(F.struct(F.lit("a").alias("name"), F.col("accession").alias("value"))).alias(c) if c == "fields" else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
    versions = Versions(spark, str(tmp_path))
    versions.write("v", {schema.RECORDS: rows})
    versions.publish("v")
    store = Store(spark, str(tmp_path))
    assert [(r.accession, r.a) for r in store.where("GEO Sample", ["a"], "status = 'live' or accession = 'none'").collect()] == [("GSM1", ["GSM1"])]
    assert store.where("GEO Sample", []).count() == 2
    for kind, condition in (("GEO sample", None), ("GEO Sample", "true; drop table x")):
        with pytest.raises(ValueError):
            store.where(kind, [], condition)
    df = spark.createDataFrame([("GSE12",), ("GSM7",), ("GPL1",)], "a string")
    assert [r[0] for r in df.select(keys.uid_of(F.col("a"))).collect()] == [200000012, 300000007, None]
    uids = spark.createDataFrame([(200000012,), (300000000,), (300000001,), (5,), (200000000,)], "u long")
    assert [r[0] for r in uids.select(keys.accession_of_uid(F.col("u"))).collect()] == ["GSE12", None, "GSM1", None, None]
    papers = {"39637862": "papers/39637nnn/39637862", "12": "papers/nnn/12", "10.1101/2024.01": "papers/doi/10.1101%2F2024.01", "10.1/a b*~(c)": "papers/doi/10.1%2Fa%20b%2A~%28c%29"}
    got = spark.createDataFrame([(k,) for k in papers], "k string").select(keys.paper_folder(F.col("k"))).collect()
    assert [r[0] for r in got] == list(papers.values())
