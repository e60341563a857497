"""Where papers stand, and closed copies of the paper tables: papers, their info, files and attempts, keyed by paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.keys import doi_of

# The tiers in order, those that are free, and what a paper says that waits on a tier.
TIERS = ("pmc", "openalex", "host", "paperpile")
FREE_TIERS = ("pmc", "host")
WAITS = {
    "pmc": "pmc-sync",
    "openalex": "openalex-backlog",
    "host": "host-link",
}
# Reasons of rows that are no papers, days of embargo, tries that errors leave a tier.
NO_PAPERS = ("placeholder", "not-article")
EMBARGO_DAYS = 365
ERROR_TRIES = 3


def _attempts(attempts: DataFrame) -> DataFrame:
    """One row for each paper with, for each tier, errors, other outcomes, whether one failed, and the last outcome.

    Sums and maxima only, so a paper with any number of attempts sends one row from each task.
    """
    at = F.struct("date", F.coalesce("account", F.lit("")), "outcome")
    cols = []
    for t in TIERS[:3]:
        here = F.col("tier") == t
        cols += [
            F.count_if(here & (F.col("outcome") == "error")).alias(f"{t}_errors"),
            F.count_if(here & (F.coalesce(F.col("outcome"), F.lit("")) != "error")).alias(f"{t}_others"),
            F.count_if(here & (F.col("outcome") == "failed")).alias(f"{t}_failed"),
            F.max_by(F.when(here, F.col("outcome")), F.when(here, at)).alias(f"{t}_last"),
        ]
    return attempts.groupBy("paper").agg(*cols)


def _files(files: DataFrame) -> DataFrame:
    """(paper, xml_tier, pdf_tier): the tier of the first held file of each kind by name; others count for nothing."""
    held = files.filter(F.col("kind").isin("xml", "pdf") & (F.coalesce("path", F.lit("")) != ""))
    of = lambda kind: F.min_by(F.when(F.col("kind") == kind, F.col("tier")), F.when(F.col("kind") == kind, F.struct("name", "tier"))).alias(f"{kind}_tier")
    return held.groupBy("paper").agg(of("xml"), of("pdf"), F.count("*").alias("n_held"))


def standings(papers: DataFrame, attempts: DataFrame, files: DataFrame, today: Column) -> DataFrame:
    """(paper, status, reason, tier, xml_tier, pdf_tier) of every paper.

    papers has paper, pmcid, openalex_pdf, host_links (array), published, status, reason, retracted; attempts paper, tier,
    date, account, outcome; files paper, kind, name, path, tier. A paper that is none keeps its reason; then
    come retracted, held, within its embargo, waiting for the nearest tier that can still serve it, and last the manual queue
    with the reason of the last tier that failed. Ties of attempts of one day go by account, then outcome.
    """
    row = papers.join(_attempts(attempts), "paper", "left").join(_files(files), "paper", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    tries = lambda t: n(f"{t}_errors") < ERROR_TRIES
    serves = {
        "pmc": (F.coalesce("pmcid", F.lit("")) != "") & (n("pmc_others") == 0) & tries("pmc"),
        "openalex": F.coalesce("openalex_pdf", F.lit(False)) & (n("openalex_failed") == 0) & tries("openalex"),
        "host": (F.size(F.coalesce("host_links", F.array().cast("array<string>"))) > 0) & (n("host_errors") + n("host_others") == 0),
    }
    nearest, waits = F.lit("paperpile"), F.lit(None).cast("string")
    for t in reversed(TIERS[:3]):
        nearest, waits = F.when(serves[t], F.lit(t)).otherwise(nearest), F.when(serves[t], F.lit(WAITS[t])).otherwise(waits)
    fresh = F.coalesce(F.col("published") > F.date_sub(today, EMBARGO_DAYS), F.lit(False))
    failed = F.when(n("host_errors") + n("host_others") > 0, F.when(F.col("host_last") == "blocked", "host-blocked").otherwise("host-failed")).when(n("openalex_errors") + n("openalex_others") > 0, "openalex-failed").otherwise("no-route")
    none = F.lit(None).cast("string")
    said = [
        ((F.col("status") == "skipped") & F.col("reason").isin(*NO_PAPERS), F.lit("skipped"), F.col("reason"), none),
        (F.col("retracted"), F.lit("skipped"), F.lit("retracted"), none),
        (n("n_held") > 0, F.lit("fetched"), none, none),
        (fresh, F.lit("waiting"), F.lit("pmc-embargo"), F.when(nearest.isin(*FREE_TIERS), nearest)),
        (waits.isNotNull(), F.lit("waiting"), waits, nearest),
    ]
    status, reason, tier = F.lit("manual"), failed, nearest
    for test, s, r, t in reversed(said):
        test = F.coalesce(test, F.lit(False))
        status, reason, tier = F.when(test, s).otherwise(status), F.when(test, r).otherwise(reason), F.when(test, t).otherwise(tier)
    return row.select("paper", status.alias("status"), reason.alias("reason"), tier.alias("tier"), "xml_tier", "pdf_tier")


def replaced(files: DataFrame) -> DataFrame:
    """Printed files of later tiers of papers whose marked-up text the first tier has given: they go."""
    own = files.filter(F.col("kind").eqNullSafe("xml") & F.col("tier").eqNullSafe(TIERS[0]) & (F.coalesce("path", F.lit("")) != "")).select("paper").distinct()
    return files.filter(F.col("kind").eqNullSafe("pdf") & ~F.col("tier").eqNullSafe(TIERS[0])).join(own, "paper", "left_semi")


def _names(papers: DataFrame) -> DataFrame:
    """(target, paper): what links call each paper: its key, PMID and every DOI it has; of papers of one name the least."""
    dois = F.concat(F.array("doi"), F.coalesce("other_dois", F.array().cast("array<string>")))
    named = F.transform(F.filter(dois, lambda d: d.isNotNull() & (d != "")), lambda d: F.concat(F.lit("DOI:"), doi_of(d)))
    own = F.filter(F.array(F.col("paper"), F.concat(F.lit("PMID:"), F.col("pmid").cast("string"))), lambda x: x.isNotNull())
    return papers.select(F.explode(F.concat(own, named)).alias("target"), "paper").groupBy("target").agg(F.min("paper").alias("paper"))


def paper_subset(tables: dict[str, DataFrame], links: DataFrame, holdings: DataFrame, types: tuple[str, ...] = ("GEO Series", "BioProject")) -> tuple[dict[str, DataFrame], DataFrame]:
    """A closed copy of the paper tables: the papers that held records of the types link, and all their rows of the other tables.

    tables has papers (paper, pmid, doi, other_dois, ...) and others with a column paper; what an account did is kept
    without its name. Links count by PMID, DOI or another name of the paper. The second result is (accession, target)
    of links whose paper the store lacks, so that nothing is left out without a word. Records and papers' names are joined
    by sorting: estimates go by the size of files, know nothing of a paper's several names, and would pass millions through the driver.
    """
    held = holdings.filter(F.col("type").isin(*types)).select(F.col("accession").alias("from")).distinct().hint("merge")
    stated = links.filter(F.col("relation").isin("PubMed", "DOI")).join(held, "from", "left_semi").select(F.col("from").alias("accession"), F.when(F.col("to").startswith("DOI:"), F.concat(F.lit("DOI:"), doi_of(F.substring("to", 5, 1 << 20)))).otherwise(F.col("to")).alias("target")).distinct()
    found = stated.join(_names(tables["papers"]).hint("merge"), "target", "left")
    wanted = found.filter("paper is not null").select("paper").distinct()
    kept = {name: df.join(wanted, "paper", "left_semi").select(*(F.lit(None).cast(df.schema[c].dataType).alias(c) if c == "account" else F.col(c) for c in df.columns)) for name, df in tables.items()}
    return kept, found.filter("paper is null").select("accession", "target")


def open_ends(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) of rows of the other tables whose paper the papers table lacks; none in a closed copy."""
    keys = tables["papers"].select("paper")
    out = None
    for name in sorted(tables):
        if name != "papers":
            n = tables[name].join(keys, "paper", "left_anti").agg(F.lit(name).alias("table"), F.count("*").cast("long").alias("n"))
            out = n if out is None else out.union(n)
    return out.filter("n > 0")
