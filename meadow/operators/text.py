"""Text extraction from documents: column expressions over whole texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def fold_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


# Places where two glued words are split (pattern, replacement), in order.
SPACING = [
    (r"([a-z])([A-Z][a-z])", "$1 $2"), (r"([a-zA-Z])(\d)", "$1 $2"), (r"(\d)([a-zA-Z])", "$1 $2"),
    (r"([.,;:])([a-zA-Z\d])", "$1 $2"), (r"([a-zA-Z])(-)([a-zA-Z])", "$1 $2 $3"), (r"([\]\)])([a-zA-Z\d\[])", "$1 $2"),
]


def fix_spacing(c: Column) -> Column:
    """Split glued case, digit and punctuation boundaries, then fold whitespace."""
    for pattern, new in SPACING:
        c = F.regexp_replace(c, pattern, new)
    return fold_space(c)


# Headers that open the section and headers that close it, in order.
START_HEADERS = ["materials and methods", "methods and materials", "methods", "experimental procedures", "experimental section",
                 "research design", "experimental design", "methodology", "study design"]
END_HEADERS = ["results", "discussion", "conclusions", "acknowledgments", "conclusion", "author contributions", "references",
               "supporting information", "data availability", "competing interests", "funding"]
NO_SECTION = "Methods section not found in text."


def section_between(text: Column) -> Column:
    """Header line, newline, and the text from the earliest start header to the first end header after it."""
    start = r"(?im)^[ \t]*(?:" + "|".join(START_HEADERS) + r")[ \t]*[:.\n\r]"
    end = r"(?i)\n\s*(?:" + "|".join(END_HEADERS) + r")\s*\n"
    at = F.regexp_instr(text, F.lit(start))
    line = F.regexp_extract(text, start, 0)
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    lead = F.length(line) - F.length(F.regexp_replace(line, r"^\s+", ""))
    area = F.substring(text, at + lead + F.length(strip(line)), F.length(text))
    stop = F.regexp_instr(area, F.lit(end))
    body = F.when(stop > 0, F.substring(area, F.lit(1), stop - 1)).otherwise(area)
    return F.when(at > 0, F.concat(strip(line), F.lit("\n"), strip(body))).otherwise(NO_SECTION)


# Patterns of methodology mentions.
MENTIONS = {
    "variable_regions": r"\b(V[1-9](?:\s*-\s*V[1-9])?)\b",
    "primer_names": r"\b([a-zA-Z0-9_-]*?(?:515F|806R|341F|907R|Eub338|Arch915|Pro341)[a-zA-Z0-9_-]*?|[FR]\s?\d{3,})\b",
    "primer_sequences": r"\b([ACGTUNRYSWKMBDHV]{15,})\b",
    "extraction_protocol_and_kits": r"\b((?:DNeasy|Power(?:Soil|Fecal)|FastDNA|FastSpin|QIAamp|Mag-Bind|ZymoBIOMICS)[\w\s-]*?Kit)\b|((?:QIAGEN|Mo\s?Bio|Zymo|Promega|NEB)[\w\s-]*?(?:extraction|isolation|DNA)\s(?:Kit|System|Reagent))|\b(bead[-\s]beating|CTAB|phenol[-\s]chloroform)\b",
    "pcr_conditions_and_kits": r"\b((?:Q5|Taq|Phusion|KAPA)[\w\s-]*?(?:Polymerase|Master Mix))\b|(\d{2}\s*cycles|\d{2}\s*°C\s*for\s*\d+\s*(?:s|min))",
    "sequencing_details": r"\b(Illumina|PacBio|Pacific Biosciences|Oxford Nanopore|Thermo Fisher|Ion Torrent)[\s,()]*(MiSeq|HiSeq|NovaSeq|iSeq|Sequel|RS\s?II|MinION|GridION|PromethION|Ion\sS5|PGM)\b",
    "sample_storage": r"\b(-20\s*°?C|-80\s*°?C|liquid nitrogen|RNAlater|DNA/RNA Shield)\b",
}


def mentions(text: Column, kind: str) -> Column:
    """Sorted distinct mentions of a kind, separators folded to one space."""
    found = F.regexp_extract_all(text, F.lit("(?i)" + MENTIONS[kind]), F.lit(0))
    sep = r"[\s,()]+" if kind == "sequencing_details" else r"\s+"
    return F.array_sort(F.array_distinct(F.transform(found, lambda m: F.trim(F.regexp_replace(m, sep, " ")))))


def dna_sequences(text: Column) -> Column:
    """Distinct sequences of 15 to 40 bases, inner spaces and dashes dropped, shortest first."""
    found = F.regexp_extract_all(F.upper(text), F.lit(r"\b([ACGTUNRYSWKMBDHV\s-]{15,50})\b"), F.lit(1))
    seqs = F.array_distinct(F.transform(found, lambda m: F.regexp_replace(m, r"[ \n-]", "")))
    ok = F.filter(seqs, lambda s: F.length(s).between(15, 40) & s.rlike("^[ACGTUNRYSWKMBDHV]+$"))
    keyed = F.array_sort(F.transform(ok, lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))
    return F.transform(keyed, lambda x: x["s"])


# Patterns of a citation clue.
AUTHOR_YEAR = r"(?i)\(?((?:[\w-]+\s?){1,3} et al\.?,? \d{4}|(?:[\w-]+\s?){1,3}, \d{4})\)?"
NUMBERED = r"[\[\(]\s*(\d+)\s*(?:[–-]\s*\d+)?(?:\s*,\s*\d+)*\s*[\]\)]"


def citations_near(docs: DataFrame, key: str, text: str, accession: str, zone: int = 40, context: int = 250) -> DataFrame:
    """key, mentions, clues, snippets: citation clues in the window after each mention of the accession."""
    t = F.regexp_replace(F.regexp_replace(F.col(text), r"\s+", " "), r"(\w)\s+(\d+)", "$1$2")
    acc = F.replace(F.col(accession), F.lit(" "), F.lit(""))
    rx = lambda n: F.concat(F.lit("(?i)\\Q"), acc, F.lit(f"\\E(?=(.{{0,{n}}}))"))
    d = docs.select(key, acc.alias("_a"), t.alias("_t"), rx(zone).alias("_z"), rx(context).alias("_c"))
    d = d.withColumn("_after", F.expr("regexp_extract_all(_t, _z, 1)")).withColumn("_ctx", F.expr("regexp_extract_all(_t, _c, 1)"))
    zones = F.transform("_after", lambda a: F.concat(F.col("_a"), a))
    years = F.flatten(F.transform(zones, lambda z: F.regexp_extract_all(z, F.lit(AUTHOR_YEAR), F.lit(1))))
    nums = F.flatten(F.transform(zones, lambda z: F.regexp_extract_all(z, F.lit(NUMBERED), F.lit(1))))
    clues = F.concat(F.transform(years, lambda y: F.concat(F.lit("Author-Year clue: "), F.trim(y))), F.transform(nums, lambda y: F.concat(F.lit("Numbered clue: "), y)))
    return d.select(key, F.size("_after").alias("mentions"), F.array_sort(F.array_distinct(clues)).alias("clues"),
                    F.transform("_ctx", lambda a: F.trim(F.concat(F.col("_a"), a))).alias("snippets"))


# Headers that open a list of references.
REFERENCE_HEADERS = r"\b(references|bibliography|works\s+cited|literature\s+cited)\b"


def reference_section(text: Column) -> Column:
    """The last third of a text from its first references header on, trimmed; empty where there is none."""
    tail = F.substring(text, F.floor(F.length(text) * 2 / 3).cast("int") + 1, F.length(text))
    found = F.regexp_extract(tail, "(?is)" + REFERENCE_HEADERS + ".*", 0)
    return F.regexp_replace(found, r"^\s+|\s+$", "")


def citation_entry(section: Column, number: Column) -> Column:
    """Entry `number` of a reference section, label and text, up to the label of the next number; null where there is none."""
    mark = lambda n: F.concat(F.lit(r"(?:\["), n, F.lit(r"\]|\b"), n, F.lit(r"\.)"))
    n = number.cast("long")
    rx = F.concat(F.lit("(?is)("), mark(n.cast("string")), F.lit(r")\s*(.*?)(?=\s*"), mark((n + 1).cast("string")), F.lit("|$)"))
    part = lambda i: F.call_function("regexp_extract", section, rx, F.lit(i))
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(part(1) != "", F.concat(part(1), F.lit(" "), strip(part(2))))


def verify_items(items: DataFrame, docs: DataFrame, key: str, item: str, text: str, is_dna: bool = False) -> DataFrame:
    """Items that occur in their document (case and spaces folded), or share a word longer than four letters with it.
    DNA items need ten bases and occur in the letters-only text."""
    j = items.join(docs.select(key, text), key)
    if is_dna:
        letters = lambda c: F.upper(F.regexp_replace(c, "[^a-zA-Z]", ""))
        ok = (F.length(letters(item)) >= 10) & F.contains(letters(text), letters(item))
        return j.filter(ok).select(key, letters(item).alias(item))
    low = lambda c: F.lower(F.regexp_replace(c, r"\s+", " "))
    words = F.filter(F.split(low(item), " "), lambda w: F.length(w) > 4)
    return j.filter(F.contains(low(text), low(item)) | F.exists(words, lambda w: F.contains(low(text), w))).select(key, item)


def tag_keywords(df: DataFrame, cols: list[str], keywords: list[str], order: str) -> DataFrame:
    """keyword, column, count, example: first whole-word keyword of each cell, counted; example is the first row in order.

    Count and example merge before the shuffle, so a keyword found in most rows stays cheap.
    """
    pattern = r"(?i)\b(" + "|".join(re.escape(k) for k in keywords) + r")\b"
    named = F.create_map(*[x for k in keywords for x in (F.lit(k.lower()), F.lit(k))])
    long = df.select(order, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot([order], cols, "column", "cell")
    hit = long.withColumn("_kw", F.lower(F.regexp_extract("cell", pattern, 1))).filter("_kw <> ''")
    return hit.groupBy(F.element_at(named, F.col("_kw")).alias("keyword"), "column").agg(
        F.count(F.lit(1)).alias("count"), F.min_by("cell", order).alias("example"))


# Phrases cut from page text, words that keep a link, entities.
BOILERPLATE = [
    "skip to main content", "an official website of the united states government", "here's how you know", "search log in dashboard",
    "publications account settings", "search in pmc", "search in pubmed", "view in nlm catalog", "add to search", "user guide",
    "permalink copy", "pmc disclaimer", "pmc copyright notice", r"the author\(s\)", "find articles by",
    "author information article notes copyright and license information",
]
LINK_WORDS = ["table", "supp", "si", "file", "data"]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
TAG_STEPS = [
    (r"(?is)<!--.*?-->", " "), (r"(?is)<script\b.*?</script>", " "), (r"(?is)<style\b.*?</style>", " "),
    (r"(?is)<a\b[^>]*?href=[\"']([^\"'>]*)[\"'][^>]*>([^<]*?(?:" + "|".join(LINK_WORDS) + r")[^<]*)</a>", " [LINK: $2 - $1] "),
    (r"(?is)<a\b[^>]*>.*?</a>", " "), (r"(?is)<[^>]+>", " "),
]


def strip_boilerplate(html: Column) -> Column:
    """Text of the article, else main, else body: links dropped unless they name data, tags and fixed phrases cut."""
    part = lambda tag: F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*)</{tag}>", 1), F.lit(""))
    c = F.coalesce(part("article"), part("main"), part("body"), html)
    for pattern, new in TAG_STEPS:
        c = F.regexp_replace(c, pattern, new)
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    c = fold_space(c)
    for phrase in BOILERPLATE:
        c = F.regexp_replace(c, "(?i)" + phrase, "")
    return fold_space(c)
