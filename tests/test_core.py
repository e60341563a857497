"""Operators, sources, tables and the stream on small inputs."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions import fields, keys, text as tx
from tessera.operators import copies, graph, log, order, papers, parse, refresh, verify
from tessera.sources import readers
from tessera.sources.tables import Versions, write_table
from tessera.store import Store, subset
from tessera.streaming.log_stream import LogTable


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_key_functions(spark):
    got = one(spark, *(keys.kind_of(F.lit(x)) for x in ("GSE12", "PRJNA3", "SRR9", "GSE", "xGSE1")))
    assert got == ("Series", "BioProject", "Run", None, None)
    assert one(spark, *(keys.bucket_of(F.lit(x), 1000) for x in ("GSE12345", "GSE12", "SRX1000"))) == ("GSE12nnn", "GSEnnn", "SRX1nnn")
    assert one(spark, keys.number_of(F.lit("GSM0042")), keys.number_of(F.lit("abc"))) == (42, None)
    assert one(spark, *(keys.normal_key(F.lit(x)) for x in (" gse1 ", "https://doi.org/10.1000/ABC", "PMID:7"))) == ("GSE1", "10.1000/abc", "PMID:7")
    assert one(spark, keys.dois_in(F.lit("see (10.1000/a.b), and 10.1000/A.B. or 10.1234/x(y)")))[0] == ["10.1000/a.b", "10.1234/x(y)"]
    assert one(spark, keys.partial_date(F.lit("2020"), F.lit("Mar"), F.lit(None)), keys.partial_date(F.lit("2020"), F.lit(None), F.lit(None)), keys.month_name_date(F.lit("Jan 05 2010"))) == (dt.date(2020, 3, 1), dt.date(2020, 1, 1), dt.date(2010, 1, 5))
    assert one(spark, keys.human_size(F.lit(10)), keys.human_size(F.lit(1536))) == ("10 B", "1.5 KiB")
    assert len(one(spark, keys.short_name(F.lit("a" * 300 + ".tar.gz")))[0]) <= 120


def test_dates_are_strict(spark):
    assert one(spark, keys.strict_date(F.lit("2020-01-02")), keys.strict_date(F.lit(""))) == (dt.date(2020, 1, 2), None)
    for bad in ("2020", "2020-1-2", "x"):
        with pytest.raises(PySparkException):
            spark.createDataFrame([(bad,)], "t string").select(keys.strict_date(F.col("t"))).collect()


def test_samples_nest(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    small, large = (set(r.k for r in rows.filter(keys.in_sample(F.col("k"), f)).collect()) for f in (0.05, 0.3))
    assert small < large and 150 < len(small) < 350 and 1300 < len(large) < 1700
    with pytest.raises(ValueError):
        keys.in_sample(F.col("k"), 0)


def test_fields(spark):
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("a", "1"), ("b", "2"), ("a", "3"))))
    other = F.array(F.struct(F.lit("a").alias("name"), F.lit("1").alias("value")), F.struct(F.lit("c").alias("name"), F.lit("2").alias("value")))
    assert one(spark, fields.values_of(pairs, "a"), fields.first_of(pairs, "b"), fields.first_of(pairs, "z"), fields.differing_names(pairs, other)) == (["1", "3"], "2", None, ["a", "b", "c"])
    assert one(spark, *fields.as_json_lists(pairs)) == ('["a","b","a"]', '["1","2","3"]')


def test_text(spark):
    soft = "^SERIES = GSE1\n!Series_title = A b\n!Series_relation = SRA: http://x/SRP001\n!empty = \n^SAMPLE = GSM2\n!Sample_x = y=z\n!sample_table_begin\n!a = b\n!sample_table_end\n"
    got = [(r.entity, r.key, [(f.name, f.value) for f in r.fields]) for r in parse.tagged_records(spark.createDataFrame([(soft,)], "raw_text string")).collect()]
    assert got == [("SERIES", "GSE1", [("Series_title", "A b"), ("Series_relation", "SRA: http://x/SRP001")]), ("SAMPLE", "GSM2", [("Sample_x", "y=z")])]
    records = parse.tagged_records(spark.createDataFrame([(soft,)], "raw_text string"))
    link = parse.relation_links(records, {"SRA": ("sra", r"[SED]RP\d+", False)}, "soft").collect()
    assert [tuple(r) for r in link] == [("GSE1", "SRP001", "sra", "soft")]
    assert one(spark, tx.elements(F.lit('<r><a k="1">x</a><ab/><a/></r>'), "a"))[0] == ['<a k="1">x</a>', "<a/>"]
    assert one(spark, tx.inner_text(F.lit("<a>x <b>y</b>\n z</a>")))[0] == "x y z"
    assert one(spark, tx.text_from_places(F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2)))))[0] == "a b a"
    assert one(spark, parse.read_structure(F.array(F.lit(28.5), F.lit(0.2), F.lit(94.0))))[0] == "28+94"


def test_xml(spark):
    rows = spark.createDataFrame([("k1", '<P a="1"><ID>SRX7</ID><L>t1</L><L>t2</L></P>'), ("k2", "<P"), ("k3", None)], "key string, raw_text string")
    flat = parse.flatten_xml(rows)
    assert [(r.path, r.value) for r in flat.filter("key = 'k1'").orderBy("pos").collect()] == [("P@a", "1"), ("P/ID", "SRX7"), ("P/L", "t1"), ("P/L", "t2")]
    assert flat.filter("path = '!error'").count() == 1
    rec = parse.records_of(flat.filter("key = 'k1'"), {"label": "P/L", "none": "P/Z"}).first()
    assert (rec.label, rec.none, len(rec.fields)) == ("t1", None, 4)
    assert [tuple(r) for r in parse.links_of(flat, [("P/ID", "experiment", r"SRX\d+"), ("P/L", "x", r"\d+")], "xml").collect()] == [("k1", "SRX7", "experiment", "xml")]


def test_log_reads_before_and_after_packing_agree(spark):
    kind = "k string, v string, gone boolean"
    base = spark.createDataFrame([("a", "1", False), ("b", "1", False), ("c", "1", False)], kind)
    d1 = spark.createDataFrame([("a", "2", False), ("b", None, True)], kind)
    d2 = spark.createDataFrame([("b", "3", False), ("c", None, True), ("d", "3", False)], kind)
    read = {tuple(r)[:2] for r in log.merged(base, d1, d2, key=["k"], removed="gone").collect()}
    packed = log.merged(base, d1, key=["k"], removed="gone")
    assert read == {tuple(r)[:2] for r in log.merged(packed, d2, key=["k"], removed="gone").collect()} == {("a", "2"), ("b", "3"), ("d", "3")}
    tally = log.change_tally(base, log.merged(base, d1, d2, key=["k"], removed="gone"), "k", "v", F.lit("x")).first()
    assert tuple(tally) == ("x", 1, 2, 1)


def test_kept_copies(spark):
    rows = spark.createDataFrame([("a", "2020-01-01", 2), ("a", "2021-01-01", 3), ("b", None, 5), ("b", "2021-01-01", 6), ("c", "2020-01-01", 2), ("c", "2020-01-01", 1)], "k string, d string, n int")
    got = {r.k: r.n for r in copies.kept(rows, ["k"], F.col("d"), [F.col("n")]).collect()}
    assert got == {"a": 3, "b": 5, "c": 1}


def test_walks_and_closures(spark):
    edges = spark.createDataFrame([("A1", "B1", "r"), ("B1", "C1", "s"), ("C1", "A1", "s"), ("B1", "B2", "x"), ("B2", "C9", "s")], "from string, to string, relation string")
    roots = spark.createDataFrame([("A1",), ("B2",)], "key string")
    assert {tuple(r) for r in graph.walk(edges, roots, [("A", "r", False), ("B", "s", False)]).collect()} == {("A1", "A1"), ("A1", "B1"), ("A1", "C1"), ("B2", "B2"), ("B2", "C9")}
    barred = spark.createDataFrame([("B2",)], "key string")
    assert {r.key for r in graph.closure(edges, roots.limit(1), ["r", "s", "x"], barred=barred).collect()} == {"A1", "B1", "C1"}
    assert {tuple(r) for r in graph.one_ended(edges, spark.createDataFrame([("B1",)], "key string")).collect()} == {("B1", "A1", "r"), ("B1", "C1", "s"), ("B1", "B2", "x")}


def test_refresh_guards(spark):
    kind = "k string, v string"
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], kind)
    new = spark.createDataFrame([("b", "2"), ("d", "2")], kind)
    listed = spark.createDataFrame([("a",), ("b",), ("d",)], "k string")
    assert {tuple(r) for r in refresh.patched(old, new, listed, "k").collect()} == {("a", "1"), ("b", "2"), ("d", "2")}
    with pytest.raises(refresh.TooManyLost):
        refresh.patched(old, new, listed.limit(1), "k", least=1)
    diff = refresh.copy_diff(new, old, "k", ["v"])
    assert {tuple(r) for r in diff.collect()} == {("a", "delete"), ("c", "delete"), ("b", "send"), ("d", "send")}
    with pytest.raises(refresh.TooManyLost):
        refresh.guarded(diff, 3)
    assert refresh.guarded(diff, 3, accepted=2).count() == 4


def test_quota_is_dealt_like_a_loop(spark):
    accounts = [("b", 3), ("a", 1), ("c", 0), ("d", 2)]
    left, want = dict(accounts), []
    while any(left.values()):
        for name in sorted(left):
            if left[name]:
                left[name] -= 1
                want.append(name)
    ranked = spark.range(1, 10).select(F.col("id").alias("rank"))
    assert [r.account for r in refresh.dealt_quota(ranked, accounts, "rank").orderBy("rank").collect()] == want


def test_ranks_over_ranges(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v"), F.concat(F.lit("K"), F.col("id").cast("string")).alias("key")).repartition(7)
    assert order.ranked(rows, [F.col("v")]).filter("rank <> v").count() == 0
    assert {(r.k, r.cut) for r in order.quantiles(rows, "v", 4).collect()} == {(1, 249), (2, 499), (3, 749)}
    assert {(r.k, r.cut) for r in order.quantiles(rows.limit(0), "v", 4).collect()} == set()
    assert {(r.k, r.cut) for r in order.quantiles(rows.filter("v = 5"), "v", 3).collect()} == {(1, 5), (2, 5)}
    got = [r.key for r in order.natural_rank(rows.select("key"), "key").orderBy("place").collect()]
    assert got == [f"K{k}" for k in range(1000)]


def test_paper_rules(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, word string")
    papers.check_rules(rows, ["k"], ["word"], {"word": ["x", "y"]})
    for bad, key, words in ((rows.union(rows), ["k"], ["x", "y"]), (rows, ["k"], ["x"])):
        with pytest.raises(papers.BrokenRule):
            papers.check_rules(bad, key, [], {"word": words})
    table = spark.createDataFrame([("p1", ["d1", "d2"]), ("p2", ["d2", "p1"])], "key string, alias array<string>")
    wanted = spark.createDataFrame([("p1",), ("d2",), ("zz",)], "wanted string")
    assert {tuple(r) for r in papers.alias_lookup(wanted, table, "key", "alias").collect()} == {("p1", "p1"), ("d2", "p1")}
    merged = papers.merged_lists(spark.createDataFrame([("p", ["b"]), ("p", ["a", "b"])], "k string, l array<string>"), "k", ["l"]).first()
    assert merged.l == ["a", "b"]


def test_tables_and_store(spark, tmp_path):
    rec = [(f"GSE{k}", "Series", "public", "2020-01-01", "", None, [("title", f"t{k}"), ("tag", "x")], f"raw{k}", "h", None) for k in range(50)]
    kind = "accession string, type string, status string, submitted string, updated string, published string, fields array<struct<name: string, value: string>>, raw_text string, content_hash string, snapshot_date date"
    edges = spark.createDataFrame([(f"GSE{k}", f"GSM{k % 7}", "sample", "soft") for k in range(50)], "from string, to string, relation string, source string")
    known = spark.createDataFrame([("GSE1", "geo", dt.date(2020, 1, 1)), ("GSE999", "geo", dt.date(2020, 2, 1))], "accession string, source string, snapshot_date date")
    v = Versions(spark, str(tmp_path / "store"))
    v.write("b1", {schema.RECORDS: spark.createDataFrame(rec, kind), schema.LINKS_BY_FROM: edges, schema.LINKS_BY_TO: edges, schema.HOLDINGS: spark.createDataFrame([(r[0], "Series") for r in rec], "accession string, type string"), schema.KNOWN: known})
    with pytest.raises(FileNotFoundError):
        v.current()
    v.publish("b1")
    s = Store(spark, str(tmp_path / "store"))
    assert [r.accession for r in s.open_many(["gse3", "GSE1", "GSE3", "GSE777"]).orderBy("place").collect()] == ["GSE3", "GSE1"]
    assert s.links(["GSM3"]).count() == 7 and s.follow(["GSE8"], "sample").first().other == "GSM1"
    assert {tuple(r) for r in s.state_of(["GSE1", "GSE999", "GSE5000"]).collect()} == {("GSE1", "held"), ("GSE999", "not mirrored"), ("GSE5000", "not found")}
    assert s.field_table("Series", ["title"]).filter("accession = 'GSE4'").first().title == ["t4"]
    assert s.raw(["GSE2"]).first().raw_text == "raw2" and s.snapshot_dates().first().snapshot_date == dt.date(2020, 2, 1)
    assert verify.out_of_order(s.table(schema.LINKS_BY_TO), ["to", "from"]).agg(F.sum("rows")).first()[0] == 0
    outside = subset(s, ["GSE1", "GSE2"], ["none"], str(tmp_path / "sub"), "s1")
    assert {tuple(r)[:2] for r in outside.collect()} == {("GSE1", "GSM1"), ("GSE2", "GSM2")}
    assert Store(spark, str(tmp_path / "sub")).table(schema.RECORDS).count() == 2
    with pytest.raises(PySparkException):
        write_table(spark.createDataFrame([tuple("2020" if c == 3 else x for c, x in enumerate(rec[0]))], kind), schema.RECORDS, str(tmp_path / "bad"))


def test_readers(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('A\tB\nx\t-\n"q\ty\n')
    assert [tuple(r) for r in readers.tab_rows(spark, str(tmp_path / "t.tsv"), "A string, B string").collect()] == [("x", ""), ('"q', "y")]
    (tmp_path / "p.xml").write_text('<?xml version="1.0"?>\n<Set>\n<P id="1"><x/></P>\n<P id="2">\n t</P></Set>\n')
    got = {tuple(r) for r in readers.marked_records(spark, str(tmp_path / "p.xml"), "P", 'id="([^"]+)"').collect()}
    assert got == {("1", '<P id="1"><x/></P>'), ("2", '<P id="2">\n t</P>')}
    (tmp_path / "s.jsonl").write_text('{"accession": "GSE1", "gdstype": "By Sequencing", "bioproject": " PRJNA1", "samples": [{"accession": "GSM1", "title": "t"}], "gpl": "96; 570", "more": {"a": [1]}}\n\n{"accession": "GSE2", "gdstype": null}\n')
    assert {r.accession for r in readers.series_lines(spark, str(tmp_path / "s.jsonl")).collect()} == {"GSE1", "GSM1", "GPL96", "GPL570", "GSE2"}
    assert [tuple(r) for r in readers.series_targets(spark, str(tmp_path / "s.jsonl")).collect()] == [("GSE1", "By Sequencing", "PRJNA1")]
    (tmp_path / "k.txt").write_text("gse2\n\n GSE1 \nGSE2\n")
    assert [r.key for r in readers.key_list(spark, str(tmp_path / "k.txt")).orderBy("place").collect()] == ["GSE2", "GSE1"]
    (tmp_path / "c.jsonl").write_text('{"source": "a", "bucket": "b", "parts": "p", "added": 2, "replaced": 0, "removed": 1}\n{"source": "a", "bucket": "b", "parts": "p", "added": 9, "replaced": 9, "removed": 9}\n{"source": "a", "buck')
    assert [tuple(r) for r in readers.read_counts(spark, str(tmp_path / "c.jsonl")).collect()] == [("a", 2, 0, 1)]
    listing = "Archive/File\tName\tTime\tSize\tType\nArchive\tG.tar\tx\t9\tTAR\nFile\ta.gz\tx\t5\tGZ\nFile\tb.gz\tx\t?\tGZ\n"
    assert [tuple(r) for r in one(spark, readers.file_list(F.lit(listing)))[0]] == [("G.tar", "a.gz", 5), ("G.tar", "b.gz", None)]
    for day in ("2020-01-01", "2021-01-01"):
        (tmp_path / "snap" / day).mkdir(parents=True)
        (tmp_path / "snap" / day / "f.tab").write_text("x")
    assert readers.newest_snapshot(spark, str(tmp_path / "snap"), "f.tab")[0] == "2021-01-01"


def test_stream_equals_batch(spark, tmp_path):
    kind = "k string, v string, gone boolean, seq long"
    rows = [("a", "1", False, 1), ("b", "1", False, 2), ("a", "2", False, 3), ("b", None, True, 4), ("c", "1", False, 5)]
    table = LogTable(spark, str(tmp_path / "table"), ["k"], ["seq"], removed="gone")
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        table.start(stream, str(tmp_path / "check")).awaitTermination()
    assert {(r.k, r.v) for r in table.read().collect()} == {("a", "2"), ("c", "1")}
    table.upsert(spark.createDataFrame(rows[2:], kind), 1)  # a replayed batch
    assert {(r.k, r.v) for r in table.read().collect()} == {("a", "2"), ("c", "1")}


def test_walks_deeper_than_the_merge_of_rounds(spark):
    n = graph.MERGE + 3
    chain = spark.createDataFrame([(f"A{k:02}", f"A{k + 1:02}", "r") for k in range(n)], "from string, to string, relation string")
    roots = spark.createDataFrame([("A00",)], "key string")
    want = {f"A{k:02}" for k in range(n + 1)}
    assert [r.key for r in graph.closure(chain, roots, ["r"]).orderBy("key").collect()] == sorted(want)
    assert [r.node for r in graph.walk(chain, roots, [("A", "r", False)]).orderBy("node").collect()] == sorted(want)


def test_a_truncated_file_of_marked_records_raises(spark, tmp_path):
    import gzip

    whole = '<PSet>\n<P id="1"><x/></P>\n<P id="2">\n <P2>t</P2></P>'
    read = lambda path: readers.marked_records(spark, str(path), "P", 'id="([^"]+)"')
    for k, tail in enumerate(("", "\n", "</PSet>\n")):
        (tmp_path / f"w{k}.xml").write_text(whole + tail)
        assert sorted(r.key for r in read(tmp_path / f"w{k}.xml").collect()) == ["1", "2"]
    for k, cut in enumerate((whole[:-1], whole[:-4], whole[:-12], whole + '\n<P id="3"><x/', whole + "\n<P", whole + '\n<P id="3"/></PSet>', '<P id="1">only')):
        (tmp_path / f"c{k}.xml").write_text(cut)
        (tmp_path / f"c{k}.xml.gz").write_bytes(gzip.compress(cut.encode()))
        for path in (tmp_path / f"c{k}.xml", tmp_path / f"c{k}.xml.gz"):
            with pytest.raises(PySparkException, match="no end tag"):
                read(path).collect()
            with pytest.raises(PySparkException, match="no end tag"):
                read(path).count()
    # a long file read in many splits, whole and cut
    many = "".join(f'<P id="{k}">{"x" * 50}</P>\n' for k in range(5000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        (tmp_path / "m.xml").write_text(many)
        assert read(tmp_path / "m.xml").count() == 5000
        (tmp_path / "n.xml").write_text(many[:-20])
        with pytest.raises(PySparkException, match="no end tag"):
            read(tmp_path / "n.xml").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
