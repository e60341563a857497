"""Column expressions on keys: kinds, numbers, buckets, dates, digital object names, samples."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accession patterns of public sequencing archives, by record kind.
KINDS = {
    "Series": r"GSE\d+",
    "Sample": r"GSM\d+",
    "Platform": r"GPL\d+",
    "BioProject": r"PRJ[A-Z]{2}\d+",
    "BioSample": r"SAM[A-Z]{1,2}\d+",
    "Study": r"[SED]RP\d+",
    "Experiment": r"[SED]RX\d+",
    "Run": r"[SED]RR\d+",
    "SRA sample": r"[SED]RS\d+",
}


def kind_of(accession: Column) -> Column:
    """Record kind of an accession by full match; null for other text."""
    return F.coalesce(*(F.when(accession.rlike(f"^{p}$"), F.lit(k)) for k, p in KINDS.items()))


def prefix_of(key: Column) -> Column:
    """Leading letters of a key."""
    return F.regexp_extract(key, r"^([A-Za-z]+)", 1)


def number_of(key: Column) -> Column:
    """Trailing number of a key; null without one."""
    return F.nullif(F.regexp_extract(key, r"(\d+)$", 1), F.lit("")).cast("long")


# What is added to the number of a series or sample in its numeric id.
UID_OFFSETS = {
    "GSE": 200_000_000,
    "GSM": 300_000_000,
}


def uid_of(accession: Column) -> Column:
    """Numeric id of a series or sample; null for other keys."""
    return F.coalesce(*(F.when(accession.rlike(f"^{p}[0-9]+$"), F.lit(n) + F.substring(accession, 4, 20).cast("long")) for p, n in UID_OFFSETS.items()))


def accession_of_uid(uid: Column) -> Column:
    """The series or sample of a numeric id; null for an id of neither. Ids of a kind run to the next kind's first."""
    out, after = F.lit(None).cast("string"), 400_000_000
    for p, n in sorted(UID_OFFSETS.items(), key=lambda x: -x[1]):
        out = F.when((uid > n) & (uid < after), F.concat(F.lit(p), (uid - n).cast("string"))).otherwise(out)
        after = n
    return out


def paper_folder(key: Column) -> Column:
    """Folder of a paper: that of a number in a group of a thousand, that of a name in one of names, with all but plain characters escaped."""
    group = F.regexp_replace(key, r".{1,3}$", "")
    # url_encode writes a blank as + and escapes ~, which a path does not
    name = F.replace(F.replace(F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.when(key.rlike("^[0-9]+$"), F.concat(F.lit("papers/"), group, F.lit("nnn/"), key)).otherwise(F.concat(F.lit("papers/doi/"), name))


def bucket_of(key: Column, width: int) -> Column:
    """Prefix and number with the low digits masked: width 1000 puts GSE12345 into GSE12nnn."""
    n = len(str(width)) - 1
    digits = F.regexp_extract(key, r"(\d+)$", 1)
    head = F.when(F.length(digits) > n, F.substring(digits, F.lit(1), F.length(digits) - n)).otherwise(F.lit(""))
    return F.concat(prefix_of(key), head, F.lit("n" * n))


def normal_key(text: Column) -> Column:
    """Trimmed upper-case key; digital object names are lower-cased without a resolver prefix, PMID: keys stay as they are."""
    t = F.trim(text)
    return F.when(t.rlike(r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)?10\.\d{4,9}/"), doi_of(t)).when(t.startswith("PMID:"), t).otherwise(F.upper(t))


def doi_of(text: Column) -> Column:
    """Digital object name without resolver prefix, lower case."""
    return F.lower(F.regexp_replace(F.trim(text), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", ""))


def dois_in(text: Column) -> Column:
    """Distinct digital object names in free text in order of first mention, without trailing punctuation."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(10\.[0-9]{4,9}/[^ \t\r\n\"<>]+)"), F.lit(1))

    def closed(d: Column) -> Column:
        """Without closing brackets at the end that nothing opens."""
        count = lambda c: F.length(d) - F.length(F.replace(d, F.lit(c), F.lit("")))
        over = F.greatest(count(")") - count("("), F.lit(0))
        return F.substring(d, F.lit(1), F.length(d) - F.least(over, F.length(F.regexp_extract(d, r"(\)*)$", 1))))

    plain = lambda d: F.regexp_replace(d, r"[.,;:'!?\]}]+$", "")
    clean = F.transform(found, lambda d: F.lower(plain(closed(plain(d)))))
    return F.array_distinct(clean)


# What publishers' addresses add to a digital object name: pages and folders behind it, the path before it, and preprint servers.
PAGE_TAILS = ("full", "abstract", "pdf", "epdf")
FILE_FOLDERS = ("mediaobjects", "attachment", "suppl_file")
PREPRINT_SERVERS = ("10.1101/", "10.64898/")
PREPRINT_TAILS = (".full", ".full-text", ".full.pdf", ".abstract", ".pdf")


def linked_dois(text: Column) -> Column:
    """Distinct digital object names that addresses and citations name, in order, without what an address adds.

    Percent escapes are read first. A name ends before white space, quotes, angle brackets and ?, #, &, and
    loses closing punctuation and brackets that nothing opens, page and file tails, an article's number where
    the address has /article/doi/ before it, and a preprint's version and view.
    """
    t = F.coalesce(text, F.lit(""))
    plain = F.when(t.contains("%"), F.coalesce(F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B"))), t)).otherwise(t)
    found = F.regexp_extract_all(plain, F.lit(r"((?i:article(?:-[a-z]+)?/doi/)?10\.[0-9]{4,9}/[^\s\"<>?#&]+)"), F.lit(1))

    def closed(d: Column) -> Column:
        """Without brackets at the end that nothing opens."""
        over = F.length(F.replace(d, F.lit("("), F.lit(""))) - F.length(F.replace(d, F.lit(")"), F.lit("")))
        end = F.length(F.regexp_extract(d, r"(\)*)$", 1))
        return F.substring(d, F.lit(1), F.length(d) - F.least(F.greatest(over, F.lit(0)), end))

    def unmarked(d: Column) -> Column:
        return F.regexp_replace(d, r"[.,;:\]'/]+$", "")

    pages, folders = "|".join(PAGE_TAILS), "|".join(FILE_FOLDERS)
    tails = "|".join(t.replace(".", r"\.") for t in sorted(PREPRINT_TAILS, key=len, reverse=True))

    def printed(d: Column) -> Column:
        d = F.regexp_replace(d, rf"(/({pages})(;.*)?|\.pdf|/({folders})/.*)$", "")
        return F.regexp_replace(d, r"^(10\.3390/[^/]*)/s[0-9]+$", "$1")

    preprint = "|".join(x.replace(".", r"\.") for x in PREPRINT_SERVERS)
    view = lambda d: F.regexp_replace(d, rf"^((?:{preprint}).*?)(v[0-9]+)?({tails})?$", "$1")
    # each step is a pass over the names, so that no expression holds another many times
    names = F.transform(found, lambda w: F.lower(F.regexp_replace(w, r"^(?i:article)[^/]*/doi/", "@")))

    def ended(names: Column) -> Column:
        """Names without marks at their end; most have none, and are left as they are."""
        clean = names
        for step in (unmarked, closed, unmarked, closed, unmarked):
            clean = F.transform(clean, step)
        return F.when(F.exists(names, lambda d: F.instr(F.lit(".,;:]'/)"), F.substring(d, -1, 1)) > 0), clean).otherwise(names)

    names = F.get(F.transform(F.array(names), ended), 0)
    names = F.transform(names, lambda d: F.when(d.startswith("@"), F.regexp_replace(F.substring(d, 2, 1 << 20), r"/[0-9]+(/[^/]*)?$", "")).otherwise(d))
    return F.array_distinct(F.transform(F.transform(names, printed), view))


def strict_date(text: Column) -> Column:
    """Date of yyyy-MM-dd text; empty is null; anything else raises, also short forms that a cast would take."""
    t = F.nullif(text, F.lit(""))
    return F.when(t.isNull(), F.lit(None)).when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(t, "yyyy-MM-dd")).otherwise(F.raise_error(F.concat(F.lit("not a date: "), t)).cast("date"))


def month_name_date(text: Column) -> Column:
    """Date of "Jan 05 2010" text; null if it is not of that form."""
    return F.try_to_timestamp(text, F.lit("MMM dd yyyy")).cast("date")


def named_date(text: Column) -> Column:
    """Date of the first "Jan 5 2010" in a text; null without one."""
    # a text without one is not parsed, as a parse that fails is slow
    found = F.nullif(F.regexp_extract(text, r"([A-Z][a-z]{2} [0-9]{1,2} [0-9]{4})", 1), F.lit(""))
    return F.try_to_timestamp(found, F.lit("MMM d yyyy")).cast("date")


def partial_date(year: Column, month: Column, day: Column) -> Column:
    """Date of a year and perhaps month (number or English name) and day; missing parts are the first."""
    # English month abbreviations.
    names = "JanFebMarAprMayJunJulAugSepOctNovDec"
    at = F.instr(F.lit(names), F.initcap(F.substring(month, 1, 3)))
    number = F.when(month.rlike(r"^\d+$"), month.try_cast("int")).when(at > 0, (F.floor((at - 1) / 3) + 1).cast("int")).otherwise(F.lit(1))
    return F.make_date(year.cast("int"), F.coalesce(number, F.lit(1)), F.coalesce(day.cast("int"), F.lit(1)))


def under_embargo(published: Column, today: Column, days: int = 365) -> Column:
    """True if published within so many days before today."""
    return F.coalesce(F.datediff(today, published) <= days, F.lit(False))


def hash_share(key: Column, seed: str) -> Column:
    """Number in 0..2**60-1 that a key always has under a seed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 15), 16, 10).cast("long")


def in_sample(key: Column, fraction: float, seed: str = "round:") -> Column:
    """True for about that fraction of keys; the sample of a smaller fraction lies inside that of a larger one; null is false."""
    if not 0 < fraction <= 1:
        raise ValueError("a fraction is above 0 and at most 1")
    return F.coalesce(hash_share(key, seed) < int(fraction * 2**60), F.lit(False))


def human_size(size: Column) -> Column:
    """Bytes in binary units with one decimal."""
    e = F.least(F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1))) / 10), F.lit(0)), F.lit(4))
    unit = F.element_at(F.array(*map(F.lit, ("B", "KiB", "MiB", "GiB", "TiB"))), (e + 1).cast("int"))
    return F.when(e == 0, F.concat(size.cast("string"), F.lit(" B"))).otherwise(F.concat(F.format_number(size / F.pow(F.lit(1024), e), 1), F.lit(" "), unit))


def short_name(name: Column, most: int = 120) -> Column:
    """A file name of at most `most` characters: longer ones keep head and extension around a hash."""
    ext = F.regexp_extract(name, r"(\.[A-Za-z0-9]{1,8})$", 1)
    head = F.substring(name, F.lit(1), F.lit(most - 9) - F.length(ext))
    return F.when(F.length(name) <= most, name).otherwise(F.concat(head, F.lit("-"), F.substring(F.md5(name), 1, 8), ext))
