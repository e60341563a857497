"""What live series reach in one hop: experiments, samples and projects named by texts, listings and tab rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.keys import kind_of
from tessera.functions.text import query_value, relation_lines

from .graph import closure

# Labels of the relation lines by which one series names another, and by which a sample names its experiment.
SERIES_LABELS = ("Reanalysis of", "SuperSeries of", "SubSeries of")
EXPERIMENT_LABEL = "SRA"
SAMPLE = r"GSM\d+"
WHOLE_KEY = r"^[A-Z]+[0-9]+$"


def named_series(text: Column) -> Column:
    """Series that the relation lines of a series name."""
    rows = F.filter(relation_lines(text, "Series"), lambda r: r["label"].isin(*SERIES_LABELS) & (kind_of(r["far"]) == "Series"))
    return F.transform(rows, lambda r: r["far"])


def named_experiments(text: Column) -> Column:
    """Experiments whose address the relation lines of samples give."""
    keys = F.transform(F.filter(relation_lines(text, "Sample"), lambda r: r["label"] == EXPERIMENT_LABEL), lambda r: query_value(r["far"], "term"))
    return F.filter(keys, lambda k: F.coalesce(kind_of(k) == "Experiment", F.lit(False)))


def named_in(texts: DataFrame, named: Callable[[Column], Column], keys: DataFrame | None = None) -> DataFrame:
    """(found): what texts (key, raw_text) of the keys (key), or all, name; each once."""
    rows = texts if keys is None else texts.join(keys.select("key").distinct(), "key", "left_semi")
    return rows.select(F.explode(named(F.col("raw_text"))).alias("found")).distinct()


def related(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """(key): the roots and every series that texts name by a relation line, in turn. A series without a text is reached, and ends there."""
    named = texts.select(F.col("key").alias("from"), F.explode(named_series(F.col("raw_text"))).alias("to"))
    return closure(named.withColumn("relation", F.lit("names")), roots, ["names"])


def tab_experiments(tab: DataFrame) -> DataFrame:
    """(accession, status, sample) of the experiment rows of a tab; the sample stands in the alias of rows of center GEO, and is null else."""
    sample = F.when(F.col("Center") == "GEO", F.nullif(F.regexp_extract("Alias", SAMPLE, 0), F.lit("")))
    return tab.filter(F.col("Type") == "EXPERIMENT").select(F.trim("Accession").alias("accession"), F.col("Status").alias("status"), sample.alias("sample"))


def samples_under(listing: DataFrame, series: DataFrame) -> DataFrame:
    """(sample): samples that a listing (accession, samples) has under the series (key); each once."""
    rows = listing.join(series.select(F.col("key").alias("accession")).distinct(), "accession", "left_semi")
    return rows.select(F.explode("samples").alias("sample")).distinct()


def experiments_under(tab: DataFrame, parents: DataFrame) -> DataFrame:
    """(accession): experiments of tab rows whose project or study is a parent (key); a run stands for its experiment.

    Either end is an equi-join of its own, so nothing is compared crosswise.
    """
    wanted = parents.select("key").distinct()
    rows = tab.filter(F.col("Type").isin("EXPERIMENT", "RUN")).select("BioProject", "Study", F.when(F.col("Type") == "EXPERIMENT", F.col("Accession")).otherwise(F.col("Experiment")).alias("accession"))
    ends = [rows.join(wanted.withColumnRenamed("key", end), end, "left_semi").select("accession") for end in ("BioProject", "Study")]
    return ends[0].union(ends[1]).filter("accession <> ''").distinct()


def experiment_list(texts: DataFrame, tab: DataFrame, listing: DataFrame, series: DataFrame) -> DataFrame:
    """(accession, status) of experiments that texts of the series name, or whose sample is listed under one; status is empty where the tab lacks it."""
    own = tab_experiments(tab)
    by_sample = own.join(samples_under(listing, series), "sample", "left_semi").select("accession")
    wanted = by_sample.union(named_in(texts, named_experiments, series)).distinct()
    status = own.groupBy("accession").agg(F.max("status").alias("status"))
    return wanted.join(status, "accession", "left").filter(F.col("accession").rlike(WHOLE_KEY)).select("accession", F.coalesce("status", F.lit("")).alias("status"))


def reached(texts: DataFrame, tab: DataFrame, listing: DataFrame, links: DataFrame, live: DataFrame) -> DataFrame:
    """(accession): experiments that live series (key) reach by their texts, their listed samples, or saved links (from, to, relation)."""
    linked = links.filter("relation = 'SRA'").join(live.select(F.col("key").alias("from")).distinct(), "from", "left_semi").select(F.col("to").alias("accession"))
    return experiment_list(texts, tab, listing, live).select("accession").union(linked).distinct()


def linked_projects(*links: DataFrame) -> DataFrame:
    """(key): projects that any of the link tables (from, to, relation) names; each once."""
    return reduce(DataFrame.union, [t.filter("relation = 'BioProject'").select(F.col("to").alias("key")) for t in links]).distinct()


def held(kind: Column, path: Column) -> Column:
    """True for a file of a paper that counts as held: its text, marked up or printed, with a path."""
    return F.coalesce(kind.isin("xml", "pdf") & (path != ""), F.lit(False))
