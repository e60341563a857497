"""Work that must not grow faster than the input: texts shuffled once, key lists sent to the texts, and texts read once."""

import pytest
from pyspark.sql import functions as F

from tessera import schema, store
from tessera.operators import packages, paper_files, parts, rounds, rules, standing
from tessera.sources.tables import write_table


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange ")


PLAIN = "<?xml version='1.0'?>\n<P><RUN accession='R1' x=\"a&amp;b\">t&#65; <Read index='1'/>\n<q>é</q> </RUN><RUN accession='R2'/></P>"


@pytest.mark.parametrize("text", [PLAIN, PLAIN.replace("<q>", "<!-- c --><q>"), PLAIN.replace("é", "<![CDATA[<é>]]>"), PLAIN.replace("é", "a > b"), PLAIN.replace("\n", "\r\n")])
def test_plain_markup_is_read_as_by_events(monkeypatch, text):
    shape = parts.Shape(wanted=("RUN", "q"), texts=("RUN",), plain=("q",))
    seen = lambda: [(p.tag, p.accession, p.within, p.owner, p.fields, p.text) for p in parts.xml_parts(text, shape)]
    found = seen()
    monkeypatch.setattr(parts, "_is_plain", lambda t: False)
    assert found == seen() and len(found) == 4


def test_runs_are_read_in_one_pass_with_one_shuffle(spark):
    rows = spark.createDataFrame([("b", "<P><RUN accession='R1'><Read index='0' average='9'/></RUN></P>"), ("a", "<P><RUN accession='R1'><Read index='1' average='2.5'/><Read index='0' average='1'/></RUN></P>"), ("c", "<P>")], "accession string, raw_text string")
    found = parts.run_blocks(rows)
    assert [(r.accession, r.lengths) for r in found.collect()] == [("R1", [1, 2])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and exchanges(found) == 1


def test_kept_copies_are_shuffled_once(spark):
    row = "origin string, n int, accession string, type string, updated date, raw_text string, content_hash string"
    found = rules.kept_records(spark.createDataFrame([("GSE2", 0, "GSM1", "GEO Sample", None, "x", "h"), ("GSE1", 0, "GSM1", "GEO Sample", None, "y", "i")], row))
    assert [r.raw_text for r in found.collect()] == ["y"] and exchanges(found) == 1


def test_equal_links_are_told_where_they_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b", "r", "s")] * 3 + [("a", "c", "r", "s")], "from string, to string, relation string, source string")
    write_table(rows, schema.LINKS_BY_FROM, str(tmp_path / "links"), within=lambda r: r.distinct())
    assert spark.read.parquet(str(tmp_path / "links")).count() == 2
    dealt = rows.repartitionByRange("from", "to", "relation", "source").distinct()
    assert exchanges(dealt) == 1


def test_a_short_table_of_keys_goes_to_the_records(spark, monkeypatch):
    keys = spark.range(5).select(F.col("id").cast("string").alias("key")).distinct()
    few, marked = store.short_list(keys)
    joined = spark.range(100).select(F.col("id").cast("string").alias("key")).hint("shuffle_merge").join(marked, "key")
    assert sorted(few) == list("01234") and "broadcast" in marked._jdf.queryExecution().logical().toString().lower() and joined.count() == 5
    monkeypatch.setattr(store, "FEW_KEYS", 2)
    monkeypatch.setattr(store, "MANY_KEYS", 3)
    few, plain = store.short_list(keys)
    assert few is None and "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()


def test_papers_are_read_once_whatever_is_chosen(spark):
    papers = spark.createDataFrame([("P", "<a xmlns:xlink='x'><fig><label>F</label><graphic xlink:href='f'/></fig><inline-graphic xlink:href='i.gif'/></a>")], "paper string, raw_text string")
    listing = spark.createDataFrame([("P", "f.gif", 1), ("P", "f.jpg", 2), ("P", "i.gif", 3), ("P", "z.zip", 4)], "paper string, name string, size long")
    chosen = paper_files.chosen_files(listing, paper_files.named_files(papers))
    assert sorted((r.name, r.kind, r.label) for r in chosen.collect()) == [("f.jpg", "figure", "F"), ("z.zip", "supplement", None)]
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_files_of_papers_do_not_pass_through_the_driver(spark, tmp_path):
    spark.createDataFrame([("P", "<a xmlns:xlink='x'><fig><graphic xlink:href='f'/></fig></a>")], "paper string, raw_text string").write.parquet(str(tmp_path / "papers"))
    spark.createDataFrame([("P", "f.gif", 1), ("P", "z.zip", 4)], "paper string, name string, size long").write.parquet(str(tmp_path / "listing"))
    chosen = paper_files.chosen_files(spark.read.parquet(str(tmp_path / "listing")), paper_files.named_files(spark.read.parquet(str(tmp_path / "papers"))))
    assert sorted((r.name, r.kind) for r in chosen.collect()) == [("f.gif", "figure"), ("z.zip", "supplement")]
    assert "Broadcast" not in chosen._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_small_tables_are_dealt_before_they_become_texts(spark, sf_dir):
    from tessera.plans import build_queries, round_queries

    for made in (build_queries._projects, build_queries._samples, build_queries._packages, round_queries._articles):
        assert made(spark, sf_dir).rdd.getNumPartitions() == build_queries._tasks(spark) == 8


def test_a_breadth_of_many_rounds_shuffles_its_states_once(spark):
    seen = spark.createDataFrame([("a",)], "key string").withColumn("round", F.lit(0))
    got = seen.select("key").limit(0)
    for depth in range(1, 6):
        key = spark.createDataFrame([(f"k{depth}",)], "key string")
        seen = seen.union(key.withColumn("round", F.lit(depth)))
        got = got.union(key.filter(F.lit(depth % 2 == 1)))
    found = rounds._states(seen, got.union(spark.createDataFrame([("unseen",)], "key string")))
    assert {tuple(r) for r in found.collect()} == {("a", 0, False), ("k1", 1, True), ("k2", 2, False), ("k3", 3, True), ("k4", 4, False), ("k5", 5, True)}
    assert exchanges(found.filter("not held").select("key")) == 1 and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [0, 100])
def test_a_breadth_is_the_same_with_short_and_long_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(rounds, "FEW_KEYS", few)
    texts = spark.createDataFrame([("a", "b c", 0), ("b", "d a", 1), ("c", "a", 0), ("d", "", 0)], "key string, raw_text string, n int")
    fetch = lambda keys, attempt: texts.join(rounds.short(keys), "key").select("key", F.when(F.col("n") <= attempt, F.col("raw_text")).alias("raw_text"))
    named = lambda t: t.select(F.explode(F.filter(F.split("raw_text", " "), lambda x: x != "")).alias("next"))
    found = rounds.breadth_with_retry(spark.createDataFrame([("a",), ("z",)], "key string"), fetch, named)
    assert {tuple(r) for r in found.collect()} == {("a", 0, True), ("b", 1, True), ("c", 1, True), ("d", 3, True), ("z", 0, False)}


def test_names_of_papers_do_not_pass_through_the_driver(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.lit("P"), "id").alias("paper"), F.col("id").alias("pmid"), F.concat(F.lit("10.1/"), "id").alias("doi"), F.array(F.concat(F.lit("10.2/"), "id")).alias("other_dois"))
    rows.write.parquet(str(tmp_path / "papers"))
    links = spark.createDataFrame([("GSE1", "DOI:10.2/7", "DOI"), ("GSE1", "PMID:9999", "PubMed")], "from string, to string, relation string")
    held = spark.createDataFrame([("GSE1", "GEO Series")], "accession string, type string")
    kept, outside = standing.paper_subset({"papers": spark.read.parquet(str(tmp_path / "papers"))}, links, held)
    assert [r.paper for r in kept["papers"].collect()] == ["P7"] and [tuple(r) for r in outside.collect()] == [("GSE1", "PMID:9999")]
    assert "Broadcast" not in outside._jdf.queryExecution().executedPlan().toString()


def test_plain_identifiers_are_read_without_a_path(spark):
    one = '<EXTERNAL_ID namespace="BioProject">{}</EXTERNAL_ID>'
    texts = {
        "plain": ("<STUDY accession='S'>".replace("'", '"') + one.format(" PR1 ") + "<EXTERNAL_ID label=\"it's\" namespace = \"BioProject\" >PR2</EXTERNAL_ID><EXTERNAL_ID namespace=\"GEO\">GSE1</EXTERNAL_ID></STUDY>", [" PR1 ", "PR2"]),
        "none": ('<STUDY><EXTERNAL_ID namespace="BioProject"/><EXTERNAL_ID namespace="BioProject"></EXTERNAL_ID><EXTERNAL_IDS namespace="BioProject">x</EXTERNAL_IDS></STUDY>', []),
        "quotes": ("<STUDY><EXTERNAL_ID namespace='BioProject'>PR1</EXTERNAL_ID></STUDY>", ["PR1"]),
        "reference": (f"<STUDY>{one.format('P&amp;R')}</STUDY>", ["P&R"]),
        "section": (f"<STUDY><!-- {one.format('no')} -->{one.format('<![CDATA[PR1]]>')}</STUDY>", ["PR1"]),
        "nested": (f"<STUDY>{one.format('PR1<i>2</i>3')}</STUDY>", ["PR1", "3"]),
        "larger": (f'<STUDY a="x>y">{one.format("PR1")}</STUDY>', ["PR1"]),
    }
    rows = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "k string, x string")
    path = F.xpath("x", F.lit("//EXTERNAL_ID[@namespace='BioProject']/text()"))
    found = rows.select("k", packages.external_ids(F.col("x"), "BioProject").alias("ids"), path.alias("by_path")).collect()
    assert {r.k: r.ids for r in found} == {r.k: r.by_path for r in found} == {k: ids for k, (_, ids) in texts.items()}


def test_slices_are_those_of_either_form(spark):
    text = "<P><RUN/><RUN a='/x'>\n<b/></RUN><RUNS>no</RUNS><RUN b='1' /><RUN></RUN><RUN>cut off</P>"
    found = spark.createDataFrame([(text,)], "x string").select(packages.slices(F.col("x"), "RUN").alias("s")).first().s
    assert found == ["<RUN/>", "<RUN a='/x'>\n<b/></RUN>", "<RUN b='1' />", "<RUN></RUN>"]


def test_only_wanted_relations_of_packages_are_read(spark):
    text = '<P><STUDY_REF accession="S"/><STUDY accession="S"><EXTERNAL_ID namespace="BioProject">PR1</EXTERNAL_ID></STUDY><RUN accession="R"/></P>'
    rows = spark.createDataFrame([("X", text)], "accession string, raw_text string")
    whole, some = packages.package_links(rows), packages.package_links(rows, relations=("BioProject",))
    assert {tuple(r)[:3] for r in whole.collect()} == {("X", "S", "study"), ("X", "R", "run"), ("S", "PR1", "BioProject")}
    assert [tuple(r)[:3] for r in some.collect()] == [("S", "PR1", "BioProject")] and "<RUN" not in some._jdf.queryExecution().optimizedPlan().toString()


def test_plain_packages_are_read_without_a_path(spark):
    text = '<EXPERIMENT_PACKAGE><EXPERIMENT accession="X"><IDENTIFIERS><A><TITLE>no</TITLE></A></IDENTIFIERS> <TITLE> it\'s t </TITLE><STUDY_REF accession="S"/></EXPERIMENT><SUBMISSION a="b" center_name="C D"/><SUBMISSION center_name="no"/><RUN accession="R" total_spots="3"/></EXPERIMENT_PACKAGE>'
    changed = [
        ("</EXPERIMENT><SUB", "</EXPERIMENT><x/><SUB"),
        (" it's t ", "R&amp;D"),
        (" it's t ", " "),
        (" it's t ", "a<i>b</i>c"),
        ("<TITLE> it", "<!-- c --><TITLE> it"),
        ("</IDENTIFIERS> ", "</IDENTIFIERS><DESIGN><IDENTIFIERS/></DESIGN>"),
        ("<IDENTIFIERS><A>", "<IDENTIFIERS/><A><A>"),
        ('"C D"', '"C\nD"'),
        ('a="b"', 'xcenter_name="x"'),
        ("<STUDY_REF", "<EXPERIMENT_LINKS/><STUDY_REF"),
        ("<STUDY_REF", "<EXPERIMENT><SUBMISSION center_name='deep'/></EXPERIMENT><STUDY_REF"),
        ('<EXPERIMENT accession="X">', '<Q/><EXPERIMENT accession="X">'),
    ]
    texts = [text, *(text.replace(a, b).replace("</IDENTIFIERS>", "</A></IDENTIFIERS>" if "<A><A>" in b else "</IDENTIFIERS>") for a, b in changed)]
    texts[7] = text.replace("<IDENTIFIERS><A><TITLE>no</TITLE></A></IDENTIFIERS>", "<IDENTIFIERS/>")
    rows = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "accession string, raw_text string")
    at = {"title": "/EXPERIMENT_PACKAGE/EXPERIMENT/TITLE", "center": "/EXPERIMENT_PACKAGE/SUBMISSION/@center_name"}
    want = rows.select("accession", *(packages.first_at(F.col("raw_text"), p).alias(c) for c, p in at.items())).collect()
    found = packages.experiments_of(rows).collect()
    assert sorted((r.accession, r.title, r.center) for r in found) == sorted(map(tuple, want)) and {(tuple(r.runs), r.spots) for r in found} == {(("R",), 3)}
    plain = rows.select("accession", F.regexp_extract("raw_text", packages._TITLE, 1).alias("t"), F.regexp_extract("raw_text", packages._CENTER, 1).alias("c")).collect()
    assert [(r.t, r.c) for r in plain if r.accession == "0"] == [(" it's t ", "C D")]


def test_links_of_tagged_texts_come_from_one_pass(spark):
    field = "array<struct<name:string,value:string>>"
    rows = spark.createDataFrame([("SAMPLE", "GSM1", [("series_id", "GSE1"), ("platform_id", "GPL1"), ("title", "t")]), ("SERIES", "GSE1", [("pubmed_id", "7"), ("sample_id", "GSM1"), ("sample_id", "GSM2")])], f"entity string, key string, fields {field}")
    found = packages.soft_links(rows)
    assert sorted(tuple(r)[:3] for r in found.collect()) == [("GSE1", "GSM1", "sample"), ("GSE1", "GSM2", "sample"), ("GSE1", "PMID:7", "PubMed"), ("GSM1", "GPL1", "platform")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_tagged_texts_are_parsed_without_passing_them_on(spark):
    text = "lost\n^SERIES = GSE1\r\n!Series_title = a = b\n!Series_empty = \n!series_table_begin\n!x = 1\n!series_table_end\n!y = 2\n^SAMPLE = GSM1\n!sample_table_begin\n!z = 3\n^PLATFORM = GPL1\n!p = q"
    found = parts.tagged_parts(text)
    assert "lost\n" + "".join(p.text for p in found) == text
    assert [(p.tag, p.accession, p.fields) for p in found] == [("SERIES", "GSE1", [("Series_title", "a = b"), ("Series_empty", ""), ("y", "2")]), ("SAMPLE", "GSM1", []), ("PLATFORM", "GPL1", [("p", "q")])]
    rows = spark.createDataFrame([("GSE1", text), ("GSE2", "")], "accession string, raw_text string")
    whole, short = ({(r.origin, r.n): r for r in parts.parsed_tagged(rows, texts=t).collect()} for t in (True, False))
    assert len(short) == 4 and all(r.raw_text is None and r.asDict() | {"raw_text": None} == whole[k].asDict() | {"raw_text": None} for k, r in short.items())


def test_kept_copies_are_counted_in_the_same_pass(spark):
    rows = spark.createDataFrame([("GSE1", "^PLATFORM = GPL1\n!Platform_title = a\n"), ("GSE2", "^PLATFORM = GPL1\n!Platform_title = b\n"), ("GSE3", "^PLATFORM = GPL2\n")], "accession string, raw_text string")
    found = rules.kept_records(rules.soft_records(parts.parsed_tagged(rows)), count="n")
    assert {(r.accession, r.origin, r.n) for r in found.collect()} == {("GPL1", "GSE1", 2), ("GPL2", "GSE3", 1)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


ELEMENTS = """<P><RUN accession="R1"/><RUN a="b"
 accession="R2" ><Q>x</Q></RUN><RUNS accession="no"/><RUN_SET/><RUN/><RUN /><RUN></RUN><RUN x="1">t</RUN><RUN accession=""/><RUN/x accession="no"><RUN accession="a>b"/>R</RUN>
<RUN x="/>"/><RUN a="b"/ ><i/></RUN><STUDY accession="S1"><RUN accession="R3"><STUDY_REF accession="S2"/></RUN></STUDY><SAMPLE><SAMPLE accession="N1"/></SAMPLE><SAMPLE accession="N2"/><RUN accession="cut off"><Q></P>"""


@pytest.mark.parametrize("text", [ELEMENTS, ELEMENTS.replace("<RUN/>", "<RUN>"), ELEMENTS.replace("<RUN", "<SAMPLE"), ELEMENTS.replace("</RUN>", ""), "", None, "<RUN accession=\"R1\"><RUN a='b'>" * 2, '<RUN accession="R1/>', "<P>" + '<RUN accession="R1"><Q/></RUN>' * 20000 + "</P>", "<RUN>" + "<Q/>" * 100000 + '</RUN><RUN accession="R2"/>'])
def test_accessions_are_read_as_from_slices(spark, text):
    rows = spark.createDataFrame([(text,)], "x string")
    for tag in packages.PACKAGE_PARTS:
        before = F.regexp_extract_all("x", F.lit(rf"(?s)<{tag}(?:\s[^>]*?)?(?:/>|>.*?</{tag}>)"), F.lit(0))
        read = F.transform(packages.slices(F.col("x"), tag), lambda s: F.coalesce(packages.accession_of(s, tag), F.lit("")))  # noqa: B023
        found = rows.select(before.alias("b"), packages.slices(F.col("x"), tag).alias("s"), read.alias("r"), packages.accessions(F.col("x"), tag).alias("a")).first()
        assert found.s == found.b and found.a == found.r


def test_names_of_records_come_without_their_texts(spark, sf_dir):
    from tessera.plans import build_queries

    rows = spark.createDataFrame([("X1", ELEMENTS), ("X1", "<P/>"), ("X2", '<RUN accession="R1"/>'), ("X3", None), (None, '<RUN accession="R9"/>'), ("", "<P/>")], "accession string, raw_text string")
    want = {tuple(r) for r in packages.package_records(rows).select("accession", "type").collect()}
    found = [tuple(r) for r in packages.record_keys(rows).collect()]
    assert set(found) == want and len(found) == len(want) and {("X1", "SRA experiment"), ("R9", "SRA run"), ("S1", "SRA study"), ("N1", "SRA sample"), ("R3", "SRA run")} <= want
    plan = build_queries.package_records(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [line for line in plan if "Generate " in line and "raw_text" in line]


def test_packages_of_many_lines_are_dealt_over_more_tasks(spark, sf_dir, monkeypatch):
    from tessera.plans import build_queries

    monkeypatch.setattr(build_queries, "TASK_ROWS", 500)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert build_queries._packages(spark, sf_dir).rdd.getNumPartitions() == -(-lines // 500) > 8


def rows_of(texts, parse, form_of=None):
    """Rows of parts by forms, or each text by itself; and how often a text was parsed."""
    calls = []
    parser = parts.Parser(lambda t: calls.append(t) or parse(t), form_of or (lambda t: None))
    rows = parts._Rows()
    for n, text in enumerate(texts):
        parser.read(rows, f"o{n}", text)
    return {k: list(v) for k, v in vars(rows).items()}, len(calls)


FORMED = '<P><EXPERIMENT accession="X{0}"><TITLE>t {0}</TITLE> <A b="{1}"/></EXPERIMENT><STUDY accession="{1}"><RUN accession="R{0}">{2}</RUN></STUDY><SUBMISSION center_name="c {0}"/></P>'


def test_texts_of_one_form_are_parsed_once():
    texts = [FORMED.format(n, f"S{n % 3}", "é" * (1 + n)) for n in range(50)]
    found, calls = rows_of(texts, lambda t: parts.xml_parts(t, rules.PACKAGE), parts._markup_form)
    assert calls == 1 and found == rows_of(texts, lambda t: parts.xml_parts(t, rules.PACKAGE))[0] and found["texts"][1] == texts[0]
    tagged = [f"^SERIES = GSE{n}\n!Series_title = {'a = ' * (n % 4)}\n!Series_empty =\n!sample_table_begin\n!x = {n}\n^SAMPLE = GSM{n}\r\n!y = \n" for n in range(50)]
    found, calls = rows_of(tagged, parts.tagged_parts, parts._lines_form)
    assert calls == 1 and found == rows_of(tagged, parts.tagged_parts)[0] and found["values"][0] == ""


@pytest.mark.parametrize("value", ["", " ", "a b ", "&amp;", "&", "<", ">", '"', "'", "\n", "\r", "\t", "\0", "\x1c", "\x0b", "￾", "0", "]]>", "<b/>", "<!-- \"c\" -->", "<b c=\"d\">e</b>", '" x="', "<?p?>", "&#65;", " "])
def test_odd_values_are_read_as_without_forms(value):
    plain = FORMED.format(1, "S", "g")
    whole = [plain, *(FORMED.format(*(value if k == n else "v" for k in range(3))) for n in range(3)), plain.replace("<P>", f"<?xml version='1.0'?><P>{value}"), plain.replace("</P>", value), plain.replace('"', "'")]
    for shape in (rules.PACKAGE, parts.Shape(wanted=("TITLE", "RUN"), texts=("RUN",), plain=("TITLE",), bare=("RUN",))):
        assert rows_of(whole * 2, lambda t: parts.xml_parts(t, shape), parts._markup_form)[0] == rows_of(whole * 2, lambda t: parts.xml_parts(t, shape))[0]  # noqa: B023
    lines = ["^SERIES = v\n!a = w\nlost = 1\n", f"^SERIES = {value}\n!a = w\nlost = 1\n", f"^SERIES = v\n!a = {value}\nlost = 1\n", f"{value}^SERIES = v\n!a = w\nlost = {value}\n"]
    assert rows_of(lines * 2, parts.tagged_parts, parts._lines_form)[0] == rows_of(lines * 2, parts.tagged_parts)[0]


def test_links_of_parsed_packages_come_from_one_pass(spark):
    rows = spark.createDataFrame([("X1", FORMED.format(1, "S", "g").replace("<RUN", '<EXTERNAL_ID namespace="BioProject"> PR1 </EXTERNAL_ID><EXTERNAL_ID namespace="GEO">no</EXTERNAL_ID><RUN').replace("<TITLE>", '<STUDY_REF accession="S"/><TITLE>'))], "accession string, raw_text string")
    found = rules.package_links(parts.parsed_xml(rows, rules.PACKAGE))
    assert sorted(tuple(r) for r in found.collect()) == [("S", "PR1", "BioProject", "SRA XML"), ("S", "R1", "run", "SRA XML"), ("X1", "S", "study", "SRA XML")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_rows_are_made_once_where_ranges_come_from_keys(spark, tmp_path, monkeypatch):
    from tessera.sources import tables

    monkeypatch.setattr(tables, "RANGE_ROWS", 50)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    keys = spark.range(999).select(F.concat(F.lit("k"), F.col("id") % 700).alias("accession")).union(spark.createDataFrame([(None,)], "accession string"))
    rows = keys.mapInArrow(count, "accession string").withColumn("type", F.lit("t"))
    write_table(rows, schema.HOLDINGS, str(tmp_path / "held"), within=lambda r: r.groupBy(tables.RANGE, "accession").agg(F.first("type").alias("type")), keys=keys)
    found = spark.read.parquet(str(tmp_path / "held")).select("accession", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n")).orderBy("f", "n").collect()
    names = [r.accession for r in found]
    assert made.value == 1000 and names == [*sorted(f"k{n}" for n in range(700)), None] and len({r.f for r in found}) > 10


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99])
def test_ranges_of_keys_are_found(spark, n):
    from tessera.sources.tables import range_of

    bounds = [f"{k:03}" for k in range(10, 10 + n)]
    rows = spark.createDataFrame([(f"{k:03}",) for k in range(120)] + [("010x",), ("é",), (None,)], "k string")
    group, number = range_of(F.col("k"), bounds)
    assert all(r.at == (n + 1 if r.k is None else sum(b <= r.k for b in bounds)) for r in rows.withColumn("_group", group).withColumn("at", number).collect())


def test_listings_stay_in_their_rows_and_are_read_once(spark):
    line = "{}\t{}\t01/02/2020 03:04:05\t1\tTXT"
    text = "\r\n".join(["#head", line.format("File", "f0"), line.format("Archive", "a1"), line.format("File", "f1"), "Archive\tshort", line.format("File", "f2"), line.format("Archive", "a2"), line.format("File", "f1"), ""])
    listed = rules.listed_files(spark.createDataFrame([("GSE1", text), ("GSE2", line.format("File", "f3"))], "accession string, raw_text string"))
    assert {r.name: r.archive for r in listed.collect()} == {"f0": None, "a1": None, "f1": "a2", "f2": "a1", "a2": None, "f3": None}
    assert "Window" not in listed._jdf.queryExecution().optimizedPlan().toString()
    named = spark.createDataFrame([("GSE7", "f1", "ftp://f1"), ("GSE8", "x", "ftp://x")], "owner string, name string, url string")
    found = rules.supplementary(named, listed)
    assert {(r.name, r.owner, r.url, r.archive) for r in found.collect()} == {("f1", "GSE7", "ftp://f1", "a2"), ("x", "GSE8", "ftp://x", None), ("f0", "GSE1", None, None), ("a1", "GSE1", None, None), ("f2", "GSE1", None, "a1"), ("a2", "GSE1", None, None), ("f3", "GSE2", None, None)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("posexplode(split(text") == 1


def test_links_are_dealt_over_more_tasks_where_there_are_many(spark, tmp_path, monkeypatch):
    from .test_build import sources

    from tessera.operators import build
    from tessera.sources import tables

    monkeypatch.setattr(build, "LINK_ROWS", 2)
    monkeypatch.setattr(tables, "SMALL_ROWS", 1)
    held = build.build(spark, str(tmp_path), "v1", sources(spark), "2024-01-01").table(schema.LINKS_BY_FROM)
    assert held.select(F.input_file_name()).distinct().count() > 4 and held.count() == held.distinct().count() > 10
