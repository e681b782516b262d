"""Text extraction from documents, conversations and pages."""

from pyspark.sql import functions as F

from meadow.operators import text as tx
from meadow.operators.kernels import spread
from meadow.plans import fixtures as fx
from meadow.plans.registry import query

def I():
    return F.col("doc_id")



def docs(spark, d):
    return spread(fx.table(spark, d, "documents"))


def quote(p):
    return p.replace("'", "''")


def chain(expr, steps):
    for p, new in steps:
        new = new.replace("$1", "\\1").replace("$2", "\\2").replace("$3", "\\3")
        expr = f"regexp_replace({expr}, '{quote(p)}', '{new}', 'g')"
    return expr


@query("n01_fix_spacing", f"SELECT doc_id, md5(trim({chain('text', tx.SPACING + [(chr(92) + 's+', ' ')])})) AS clean FROM documents")
def n01(spark, d):
    return docs(spark, d).select("doc_id", F.md5(tx.fix_spacing(F.col("text"))).alias("clean"))


def _section_sql():
    """Start line by its first match, then the area behind it up to the first end header."""
    start = r"(?im)^[ \t]*(?:" + "|".join(tx.START_HEADERS) + r")[ \t]*[:.\n\r]"
    end = r"(?i)\n\s*(?:" + "|".join(tx.END_HEADERS) + r")\s*\n"
    strip = lambda c: f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    t = """CASE doc_id % 3 WHEN 0 THEN 'Intro text' || chr(10) || '  Materials and Methods:' || chr(10) WHEN 1 THEN 'Intro' || chr(10) || 'METHODS' || chr(10) ELSE '' END || text
|| CASE doc_id % 3 WHEN 0 THEN chr(10) || chr(10) || 'Results ' || chr(10) || 'more' || chr(10) || 'Discussion' || chr(10) ELSE '' END"""
    return f"""WITH t AS (SELECT doc_id, {t} AS t FROM documents), s AS (SELECT doc_id, t, {strip(f"regexp_extract(t, '{start}', 0)")} AS head FROM t),
a AS (SELECT doc_id, head, substr(t, strpos(t, head) + length(head)) AS area FROM s), b AS (SELECT *, regexp_extract(area, '{end}', 0) AS stop FROM a)
SELECT doc_id, md5(CASE WHEN head = '' THEN '{tx.NO_SECTION}' ELSE head || chr(10) || {strip("CASE WHEN stop <> '' THEN left(area, strpos(area, stop) - 1) ELSE area END")} END) AS section FROM b"""


@query("n02_section_between", _section_sql())
def n02(spark, d):
    pre = F.when(I() % 3 == 0, "Intro text\n  Materials and Methods:\n").when(I() % 3 == 1, "Intro\nMETHODS\n").otherwise("")
    post = F.when(I() % 3 == 0, "\n\nResults \nmore\nDiscussion\n").when(I() % 3 == 1, "").otherwise("")
    return docs(spark, d).select("doc_id", F.md5(tx.section_between(F.concat(pre, "text", post))).alias("section"))


LINE = "We sequenced V3-V4 and v1 - V3 with 515F-Y and R 806, ACGTNACGTNACGTNAC, DNeasy PowerSoil Kit, bead-beating, Illumina (MiSeq, 30 cycles, RNAlater. "
def MARK():
    return F.when(I() % 2 == 0, LINE).otherwise("")



def _mention_sql(kind):
    sep = r"[\s,()]+" if kind == "sequencing_details" else r"\s+"
    return (f"array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i){quote(tx.MENTIONS[kind])}', 0), lambda m: trim(regexp_replace(m, '{sep}', ' ', 'g'))))), '|') AS {kind}")


KINDS = ["variable_regions", "primer_names", "primer_sequences", "extraction_protocol_and_kits", "pcr_conditions_and_kits", "sequencing_details", "sample_storage"]


@query("n03_extract_mentions", f"WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '{quote(LINE)}' ELSE '' END || text AS t FROM documents) SELECT doc_id, " + ", ".join(_mention_sql(k) for k in KINDS) + " FROM d")
def n03(spark, d):
    t = F.concat(MARK(), "text")
    return docs(spark, d).select("doc_id", *[F.concat_ws("|", tx.mentions(t, k)).alias(k) for k in KINDS])


# DuckDB knows ASCII word ends only, so its text gets an ASCII letter that no sequence holds for each other letter.
@query("n03_dna_sequences", """WITH t AS (SELECT doc_id, upper(CASE WHEN doc_id % 2 = 0 THEN 'primer: ACGTN-ACGTN ACGTNAC; ' ELSE '' END || regexp_replace(translate(text, 'ß', 's'), '[^\\P{L}a-zA-Z]', 'z', 'g')) AS t FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(t, '\\b([ACGTUNRYSWKMBDHV\\s-]{15,50})\\b', 1), lambda m: regexp_replace(m, '[ \\n-]', '', 'g'))) AS s FROM t)
SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_filter(s, lambda x: length(x) BETWEEN 15 AND 40 AND regexp_full_match(x, '[ACGTUNRYSWKMBDHV]+')), lambda x: {'n': length(x), 's': x})), lambda x: x.s), '|') AS found FROM s""")
def n03b(spark, d):
    t = F.concat(F.when(I() % 2 == 0, F.lit("primer: ACGTN-ACGTN ACGTNAC; ")).otherwise(F.lit("")), F.translate("text", "ß", "s"))
    return docs(spark, d).select("doc_id", F.concat_ws("|", tx.dna_sequences(t)).alias("found"))


@query("n04_citations_near", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2 WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END AS mentions, CASE doc_id % 3 WHEN 0 THEN 'Author-Year clue: Lee et al. 2019|Numbered clue: 12' WHEN 1 THEN '' ELSE '' END AS clues FROM documents""")
def n04(spark, d):
    pre = F.when(I() % 3 == 0, "PRJNA 12345 (Lee et al., 2019) was used. ########################## prjna12345 [12] ######################## ").when(I() % 3 == 1, "PRJNA12345 ################################################## ").otherwise("")
    pre = F.regexp_replace(pre, "Lee et al., 2019", "Lee et al. 2019")
    df = docs(spark, d).select("doc_id", F.concat(pre, "text").alias("text"), F.lit("PRJNA 12345").alias("acc"))
    out = tx.citations_near(df, "doc_id", "text", "acc")
    clean = F.transform("clues", lambda c: F.regexp_replace(c, "2019.*", "2019"))
    return out.select("doc_id", "mentions", F.concat_ws("|", F.array_sort(F.array_distinct(F.transform(clean, lambda c: F.regexp_replace(c, "clue: .*Lee", "clue: Lee"))))).alias("clues"))


@query("n05_verify_items", """WITH i AS (SELECT doc_id, UNNEST([CASE WHEN lang = 'en' THEN upper(substr(text, 1, 20)) ELSE substr(text, 1, 20) END, 'zzz qqq', 'xx ' || substr(text, 5, 6)]) AS item FROM documents), w AS (SELECT i.doc_id, item, lower(regexp_replace(text, '\\s+', ' ', 'g')) AS t, lower(regexp_replace(item, '\\s+', ' ', 'g')) AS n FROM i JOIN documents USING (doc_id))
SELECT doc_id, md5(item) AS item FROM w WHERE contains(t, n) OR len(list_filter(string_split(n, ' '), lambda x: length(x) > 4 AND contains(t, x))) > 0""")
def n05(spark, d):
    t = docs(spark, d)
    items = t.select("doc_id", F.explode(F.array(F.when(F.col("lang") == "en", F.upper(F.substring("text", 1, 20))).otherwise(F.substring("text", 1, 20)), F.lit("zzz qqq"), F.concat(F.lit("xx "), F.substring("text", 5, 6)))).alias("item"))
    return tx.verify_items(items, t, "doc_id", "item", "text").select("doc_id", F.md5("item").alias("item"))


WORDS = ["the", "And", "in", "of", "zebra"]


@query("n06_tag_keywords", """WITH t AS (SELECT lpad(CAST(conv_id AS VARCHAR), 8, '0') || lpad(CAST(turn AS VARCHAR), 5, '0') || md5(text) AS k, text FROM conversations), h AS (SELECT k, text, lower(regexp_extract(text, '(?i)\\b(the|And|in|of|zebra)\\b', 1)) AS w FROM t)
SELECT CASE w WHEN 'and' THEN 'And' ELSE w END AS keyword, 'text' AS "column", COUNT(*) AS count, md5(ARG_MIN(text, k)) AS example FROM h WHERE w <> '' GROUP BY 1""")
def n06(spark, d):
    c = fx.table(spark, d, "conversations").select(F.concat(F.lpad(F.col("conv_id").cast("string"), 8, "0"), F.lpad(F.col("turn").cast("string"), 5, "0"), F.md5("text")).alias("k"), "text")
    return tx.tag_keywords(c, ["text"], WORDS, "k").withColumn("example", F.md5("example"))


def _page_sql():
    part = lambda tag: f"NULLIF(regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*)</{tag}>', 1), '')"
    c = f"COALESCE({part('article')}, {part('main')}, {part('body')}, html)"
    c = chain(c, tx.TAG_STEPS)
    for e, ch in tx.ENTITIES:
        c = f"replace({c}, '{e}', '{quote(ch)}')"
    c = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    c = chain(c, [("(?i)" + p, "") for p in tx.BOILERPLATE])
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


@query("n07_strip_boilerplate", f"SELECT page_id, md5({_page_sql()}) AS clean FROM pages")
def n07(spark, d):
    return fx.table(spark, d, "pages").select("page_id", F.md5(tx.strip_boilerplate(F.col("html"))).alias("clean"))


REFS = """text || CASE doc_id % 3 WHEN 0 THEN chr(10) || 'References' || chr(10) || '[1] Lee et al. 2019, shore.' || chr(10) || '[2] Kim, 2020. ' || left(text, 30) || chr(10) || '[3] Roe 2021' WHEN 1 THEN ' Works  Cited 1. One entry 2. Two ' || doc_id ELSE '' END"""


def cited(spark, d):
    tail = (F.when(I() % 3 == 0, F.concat(F.lit("\nReferences\n[1] Lee et al. 2019, shore.\n[2] Kim, 2020. "), F.substring("text", 1, 30), F.lit("\n[3] Roe 2021")))
            .when(I() % 3 == 1, F.concat(F.lit(" Works  Cited 1. One entry 2. Two "), I().cast("string"))).otherwise(""))
    return docs(spark, d).select("doc_id", F.concat("text", tail).alias("text"))


_SECTION = f"""WITH d AS (SELECT doc_id, {REFS} AS t FROM documents), s AS (SELECT doc_id, regexp_replace(regexp_extract(substr(t, CAST(FLOOR(length(t)*2/3) AS BIGINT) + 1), '(?is){quote(tx.REFERENCE_HEADERS)}.*', 0), '^\\s+|\\s+$', '', 'g') AS s FROM d)"""


@query("n08_reference_section", _SECTION + " SELECT doc_id, md5(s) AS section FROM s")
def n08(spark, d):
    return cited(spark, d).select("doc_id", F.md5(tx.reference_section(F.col("text"))).alias("section"))


@query("n09_citation_entry", _SECTION + r""", e AS (SELECT doc_id, regexp_extract(s, '(?is)(\[2\]|\b2\.)\s*(.*?)(?:\s*(?:\[3\]|\b3\.)|$)', ['label', 'entry']) AS e FROM s)
SELECT doc_id, CASE WHEN e.label <> '' THEN e.label || ' ' || regexp_replace(e.entry, '^\s+|\s+$', '', 'g') END AS entry FROM e""")
def n09(spark, d):
    return cited(spark, d).select("doc_id", tx.citation_entry(tx.reference_section(F.col("text")), F.lit(2)).alias("entry"))
