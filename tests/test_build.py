"""One parse of source texts, and the build of all sources on small texts of every kind."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from xml.parsers import expat

from tessera import schema
from tessera.functions.keys import linked_dois
from tessera.operators import build, parts, rules
from tessera.operators.parts import Shape, fault_of, tagged_parts, xml_parts

PACKAGE = """<EXPERIMENT_PACKAGE><EXPERIMENT accession="SRX1"><TITLE> a &amp; b </TITLE><STUDY_REF accession="SRP1"/><DESIGN><SAMPLE_DESCRIPTOR accession="SRS1"/></DESIGN><IDENTIFIERS><EXTERNAL_ID namespace="BioProject">PRJNA9</EXTERNAL_ID></IDENTIFIERS></EXPERIMENT>
<SUBMISSION center_name="C"/><STUDY accession="SRP1"><EXTERNAL_ID namespace="BioProject"> PRJNA1 </EXTERNAL_ID><EXTERNAL_ID namespace="GEO">GSE1</EXTERNAL_ID></STUDY>
<SAMPLE accession="SRS1"><EXTERNAL_ID namespace="BioSample">SAMN1</EXTERNAL_ID></SAMPLE><RUN_SET><RUN accession="SRR1" alias="x>y"/><RUN accession="SRR2"><B/></RUN></RUN_SET></EXPERIMENT_PACKAGE>"""
SOFT = """lead
^SERIES = GSE1
!Series_title = a = b
!Series_status = Public on Jan 5 2010
!Series_empty =
!Series_type = Expression profiling by array
!Series_relation = SubSeries of: GSE9
!Series_relation = SRA: https://x.org/sra?term=SRP1
!Series_relation = New label: any thing
!Series_web_link = see https://doi.org/10.1101/2020.01.02.003v2.full.pdf.
!Series_supplementary_file = ftp://x.org/a/GSE1_RAW.tar
^PLATFORM = GPL1
!Platform_title = {title}
!platform_table_begin
!no = 1
^SAMPLE = GSM1
!Sample_series_id = GSE1
!Sample_last_update_date = {date}
!Sample_relation = BioSample: https://x.org/biosample/SAMN1
"""
PROJECT = '<Package><Project><ProjectID><ArchiveID accession="PRJNA1"/></ProjectID><Submission submitted="2020-01-02T00:00:00"><Description><Access>public</Access></Description></Submission></Project><Link><ProjectIDRef accession="PRJNA1"/><Hierarchical type="TopAdmin"><MemberID accession="PRJNA5"/></Hierarchical></Link><Publication id="77"><DbType>ePubmed</DbType></Publication></Package>'
SAMPLE = '<BioSample accession="SAMN1" submission_date="2020-01-02T01:00:00"><Status status="live"/></BioSample>'


def sources(spark, **other):
    texts = lambda *rows: spark.createDataFrame(list(rows), "accession string, raw_text string")
    given = {
        "packages": texts(("SRX1", PACKAGE), ("SRX2", ""), ("SRX3", "<EXPERIMENT_PACKAGE>")),
        "soft": texts(("GSE1", SOFT.format(title="one", date="Jan 01 2011")), ("GSE2", SOFT.format(title="two", date="Jan 01 2012").replace("GSE1", "GSE2"))),
        "link_replies": texts(("GSE1", "GSE1\tsra\t5\tSRP1\nGSE1\tbioproject\t6\t\n")),
        "paper_replies": texts(("PRJNA1", "12 13\nx1")),
        "listings": texts(("GSE1", "#Archive/File\tName\tTime\tSize\tType\nArchive\tGSE1_RAW.tar\t01/02/2020 03:04:05\t9\tTAR\nFile\tb.txt\t01/02/2020 03:04:05\t1\tTXT\n")),
        "projects": texts(("PRJNA1", PROJECT), ("PRJNA8", "never read")),
        "samples": texts(("SAMN1", SAMPLE), ("SAMN8", "never read")),
        "tab": spark.createDataFrame([("SRX1", "live", None, None, None), ("SRX2", "suppressed", None, None, None)], "accession string, status string, submitted date, updated date, published date"),
        "series": spark.createDataFrame([("GSE1", "by Sequencing", "PRJNA1"), ("GSE7", "sequencing", ""), ("GSE8", "sequencing", ""), ("GSE6", "array", "PRJNA6")], "accession string, gdstype string, bioproject string"),
        "reasons": spark.createDataFrame([("GSE7", "withdrawn", "by its owner")], "accession string, reason string, detail string"),
        "known": spark.createDataFrame([("SRX1", "tab")], "accession string, source string"),
    }
    return build.Sources(**given | other)


def test_parts_of_xml():
    found = {(p.tag, p.accession): p for p in xml_parts(PACKAGE, rules.PACKAGE)}
    assert found["EXPERIMENT", "SRX1"].text == PACKAGE and found["EXPERIMENT", "SRX1"].fields[:2] == [("EXPERIMENT@accession", "SRX1"), ("EXPERIMENT/TITLE", " a & b ")]
    assert found["RUN", "SRR1"].text == '<RUN accession="SRR1" alias="x>y"/>' and found["RUN", "SRR2"].text == '<RUN accession="SRR2"><B/></RUN>' and found["RUN", "SRR1"].owner == "SRX1"
    assert found["STUDY", "SRP1"].fields[-1] == ("SUBMISSION@center_name", "C") and found["EXPERIMENT_PACKAGE", "SRX1"].fields == []
    assert [p.text for p in xml_parts("<é>ü<T a='>'/></é>", Shape(wanted=("T",), texts=("T",)))] == [None, "<T a='>'/>"]
    deep = "<a>" * 5000 + "x" + "</a>" * 5000
    assert len(xml_parts(deep, Shape())[0].fields) == 1


@pytest.mark.parametrize(("text", "fault"), [("<a><b></a>", "mismatched"), ("<a>", "truncated"), ("<a", "truncated"), ("<a>&</a>", "unescaped"), ("<a>&x;</a>", "unescaped"), ("<a/><a/>", "more than one"), ("<a x='1' x='2'/>", "malformed"), ("x", "malformed")])
def test_faults_are_told_apart(spark, text, fault):
    with pytest.raises(expat.ExpatError) as error:
        xml_parts(text, Shape())
    assert fault_of(error.value) == fault
    rows = spark.createDataFrame([("k", text), ("e", ""), ("n", None), ("w", "<a/>")], "accession string, raw_text string")
    assert {tuple(r) for r in parts.xml_faults(rows).collect()} == {("k", fault), ("e", "empty"), ("n", "empty")}


def test_parts_of_tagged_text():
    series, platform, sample = tagged_parts(SOFT.format(title="t", date="d"))
    assert (series.tag, series.accession, series.fields[0], series.fields[2]) == ("SERIES", "GSE1", ("Series_title", "a = b"), ("Series_empty", ""))
    assert platform.fields == [("Platform_title", "t")] and len(sample.fields) == 3 and sample.text.startswith("^SAMPLE = GSM1\n")
    assert tagged_parts("no entity\n!a = b") == [] and tagged_parts("^X = 1\n!series_table_begin\n!a = 1\n!series_table_end\n!b = 2\r\n")[0].fields == [("b", "2")]


def test_build_of_all_sources(spark, tmp_path):
    store = build.build(spark, str(tmp_path), "v1", sources(spark), "2024-01-01")
    records = {r.accession: r for r in store.table(schema.RECORDS).collect()}
    assert {a: r.type for a, r in records.items()} == {"SRX1": "SRA experiment", "SRP1": "SRA study", "SRS1": "SRA sample", "SRR1": "SRA run", "SRR2": "SRA run", "PRJNA1": "BioProject", "SAMN1": "BioSample", "GSE1": "GEO Series", "GSE2": "GEO Series", "GSM1": "GEO Sample", "GPL1": "GEO Platform"}
    assert str(records["GSE1"].published) == "2010-01-05" and records["SRX1"].status == "live" and records["PRJNA1"].status == "public" and str(records["SAMN1"].submitted) == "2020-01-02"
    assert str(records["GSM1"].updated) == "2012-01-01" and "one" in records["GPL1"].raw_text
    assert all(r.content_hash == hashlib.sha256(r.raw_text.encode()).hexdigest() for r in records.values())
    links = {tuple(r) for r in store.table(schema.LINKS_BY_TO).filter("`from` <> 'GSE2' and `to` <> 'GSE2'").collect()}
    assert links == {
        ("SRX1", "SRP1", "study", "SRA XML"), ("SRX1", "SRS1", "SRA sample", "SRA XML"), ("SRX1", "SRR1", "run", "SRA XML"), ("SRX1", "SRR2", "run", "SRA XML"), ("SRP1", "PRJNA1", "BioProject", "SRA XML"), ("SRS1", "SAMN1", "BioSample", "SRA XML"),
        ("GSE9", "GSE1", "SuperSeries of", "SOFT"), ("GSE1", "SRP1", "SRA", "SOFT"), ("GSE1", "any thing", "New label", "SOFT"), ("GSE1", "DOI:10.1101/2020.01.02.003", "DOI", "SOFT Series_web_link"), ("GSE1", "GSM1", "sample", "SOFT"), ("GSM1", "SAMN1", "BioSample", "SOFT"),
        ("GSE1", "SRP1", "SRA", "Entrez link"), ("PRJNA1", "PMID:12", "PubMed", "PubMed"), ("PRJNA1", "PMID:13", "PubMed", "PubMed"), ("GSE1", "PRJNA1", "BioProject", "GEO summary"), ("GSE6", "PRJNA6", "BioProject", "GEO summary"),
        ("PRJNA5", "PRJNA1", "umbrella of", "BioProject XML"), ("PRJNA1", "PMID:77", "PubMed", "BioProject XML"),
    }
    assert {tuple(r) for r in store.table(schema.GAPS).collect()} == {("GSE7", "withdrawn", "by its owner"), ("GSE8", "unexplained", "")}
    assert {tuple(r)[:2]: r.detail for r in store.table(schema.NOTES).collect()} == {
        ("GPL1", "copies differ"): "kept GSE1; 1 other copies, first GSE2, differ in: Platform_title",
        ("GSM1", "copies differ"): "kept GSE2; 1 other copies, first GSE1, differ in: Sample_last_update_date, Sample_series_id",
        ("GSE1", "unknown GEO relation label"): "New label: 2 links",
        ("SRX2", "no SRA package"): "status in the tab: suppressed",
        ("SRX3", "unparsable SRA package"): "not well-formed as saved: truncated: no element found: line 1, column 20",
        ("GSE1", "series type disagrees"): "Expression profiling by array",
    }
    assert {(r.owner, r.name, r["size"], r.archive) for r in store.table(schema.SUPPLEMENTARY).collect()} == {("GSE1", "GSE1_RAW.tar", 9, None), ("GSE1", "b.txt", 1, "GSE1_RAW.tar"), ("GSE2", "GSE2_RAW.tar", None, None)}
    assert build.provenance(spark, str(tmp_path), "v1").count() == 0


@pytest.mark.parametrize(("name", "text", "error"), [("packages", "<EXPERIMENT_PACKAGE/>", build.BadSource), ("projects", "<Package/>", build.BadSource), ("samples", "<BioSample", build.BadSource), ("soft", "^SERIES = GSE1\n!Series_relation = SRA: https://x.org/none", PySparkException), ("link_replies", "GSE1\tsra\t5", PySparkException), ("link_replies", "GSE1\tgene\t5\tX", PySparkException)])
def test_a_text_that_must_parse_ends_the_build(spark, tmp_path, name, text, error):
    key = {"packages": "SRX9", "projects": "PRJNA1", "samples": "SAMN1"}.get(name, "GSE1")
    bad = spark.createDataFrame([(key, text)], "accession string, raw_text string")
    with pytest.raises(error):
        build.build(spark, str(tmp_path), "v1", sources(spark, **{name: bad}), "2024-01-01")


def test_names_in_addresses(spark):
    cases = {
        "https://doi.org/10.1000/AB(2).": ["10.1000/ab(2)"], "(10.1000/x)": ["10.1000/x"], "https://x.org/article-abstract/doi/10.1093/nar/g1/123/My-title": ["10.1093/nar/g1"], "https://x.org/article/doi/10.1093/nar/g1/123": ["10.1093/nar/g1"],
        "https://x.com/doi/full/10.1002/a.1/full;x": ["10.1002/a.1"], "10.1002/a/attachment/b/c.zip": ["10.1002/a"], "https://www.mdpi.com/10.3390/c1/s1": ["10.3390/c1"], "10.1101/2020.1v3.full-text, 10.64898/z.abstract": ["10.1101/2020.1", "10.64898/z"],
        "10.1000%2Fq%28a%29 10.1000/q(a)": ["10.1000/q(a)"], "10.1000/b?x=1#c": ["10.1000/b"], "none": [], "100% 10.1000/k": ["10.1000/k"],
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", linked_dois(F.col("t")).alias("d")).collect()
    assert {r.t: r.d for r in rows} == cases
