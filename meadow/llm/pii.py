"""Personal data by bootstrapped contextual extraction.

Exact patterns find the seeds. A seed's context and its shape (digits as 9, letters as a) make lexical patterns; patterns and
the strings found in them form a graph that Spark scores in rounds, from the seeds over patterns to unseen strings and back.
Patterns of high confidence then mark strings that the exact patterns miss.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from meadow.llm.common import settle

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the exact matches, leftmost and non-overlapping per kind; failing matches are passed over."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    first = _DIGIT.search(text)
    if first:
        k = first.start()
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text, k) if all(len(p) < 4 or not p[:-3].strip("0") for p in m[0].split("."))
                and all(int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text, k):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text, max(k - 1, 0)):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(s: str) -> str:
    """Digits as 9 one by one, runs of letters as one a."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"\d", "9", s))


def coarse(s: str) -> str:
    return re.sub(r"9+", "9", shape(s))


def may_be(s: str) -> int:
    """Bits of the kinds that a candidate can be at all: an email has an @ inside, an ip four parts up to 255, a card 14 to 19
    digits passing Luhn's check, a phone number 7 to 15 digits, and none of them letters (but the email)."""
    digits = "".join(c for c in s if c in "0123456789")
    plain = not any(c.isalpha() for c in s)
    parts = s.split(".")
    ip = len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) < 4 and int(p) <= 255 for p in parts)
    return (0 < s.find("@") < len(s) - 1) | ip << 1 | (plain and 14 <= len(digits) <= 19 and luhn(digits)) << 2 | (plain and 7 <= len(digits) <= 15) << 3


MOST = 19  # digits of a candidate
_EDGE = ".,;:!?'\"<>[]{}"


def named(s: str) -> str:
    """A string as the name of a node: itself in lower case, or a digest of that where it is long."""
    s = s.lower()
    return s if len(s) <= 80 else hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def occurrences(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str], int]]:
    """(start, end, kind or -1, string, patterns, kinds it may be) of the seeds, and of candidates: tokens with an @, and runs of tokens
    that all hold a digit, MOST in all, where they may be of some kind, apart from the seeds. Patterns are a string's shape; its coarse
    shape with the word before it, the word behind it, or both; and these words alone (one and both) with whether it holds an @. A seed
    beside it counts as its kind."""
    if not spans and not _DIGIT.search(text) and "@" not in text:
        return []
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    starts, ends = {a: k for a, k, _ in spans}, {b: k for _, k, b in spans}
    taken = sorted((a, b) for a, _, b in spans)

    def word(i: int, side: int) -> str:
        if not 0 <= i < len(tokens):
            return "<edge>"
        a, b = tokens[i]
        kind = ends.get(b) if side < 0 else starts.get(a)
        w = text[a:b][:40].lower().strip(_EDGE)
        return f"<{KINDS[kind]}>" if kind is not None else "#" if _DIGIT.search(w) else w

    def patterns(s: str, left: str, right: str) -> list[str]:
        c, sort = named(coarse(s)), "@" if "@" in s else "9"
        before, behind = (w not in ("", "#", "<edge>") for w in (left, right))
        behind &= left != "#"  # the rest of a longer run of numbers
        words = [f"before|{left}|{sort}"] * before + [f"behind|{right}|{sort}"] * behind + [f"around|{left}|{right}|{sort}"] * (before and behind)
        return [f"shape|{named(shape(s))}", f"left|{left}|{c}", f"right|{right}|{c}", f"both|{left}|{right}|{c}", *words]

    out, at_token = [], [a for a, _ in tokens]
    for a, k, b in spans:
        i, j = bisect_right(at_token, a) - 1, bisect_left(at_token, b)
        out.append((a, b, k, text[a:b], patterns(text[a:b], word(i - 1, -1), word(j, 1)), 1 << k))
    mail = ["@" in text[a:b] for a, b in tokens]
    size = [0 if m else len(_DIGIT.findall(text, a, b)) for m, (a, b) in zip(mail, tokens, strict=True)]
    for i, (a, _) in enumerate(tokens):
        digits = 0
        for j in range(i, len(tokens)):
            digits += size[j]
            if (j > i and mail[i]) or not (size[j] or mail[j] and j == i) or digits > MOST:
                break
            b = tokens[j][1]
            s = text[a:b].strip(_EDGE)
            start = text.index(s, a) if s else a
            k = bisect_left(taken, (start + len(s), 0))
            if k and max(e for _, e in taken[max(0, k - 4):k]) > start:
                break
            if s and (kinds := may_be(s)):
                out.append((start, start + len(s), -1, s, patterns(s, word(i - 1, -1), word(j + 1, 1)), kinds))
    return out


_FIELDS = ("base_sha256 string, b_start array<int>, b_kind array<int>, b_end array<int>, o_start array<int>, o_end array<int>, "
           "o_kind array<int>, o_text array<string>, o_patterns array<string>, o_may array<int>")


def scan(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, row (a number of its own), base_sha256, and seeds and candidates in parallel arrays."""
    @F.pandas_udf(_FIELDS)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = seeds(text)
            occ = occurrences(text, base)
            said = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
            rows.append((hashlib.sha256(said.encode()).hexdigest(), *([x[i] for x in base] for i in range(3)), *([x[i] for x in occ] for i in range(3)),
                         [named(x[3]) for x in occ], ["\x1f".join(x[4]) for x in occ], [x[5] for x in occ]))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in _FIELDS.split(", ")])

    return docs.select("doc_id", run("text").alias("_s")).select("doc_id", F.monotonically_increasing_id().alias("row"), "_s.*")


def score_graph(edges: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8, score: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """edges (pattern, item, kind, may; kind null if unseen, distinct) -> patterns (pattern, kind, confidence) and items
    (item, kind, score), scored `rounds` times from one side of the graph to the other.

    A pattern's confidence in a kind is the sum of its items' scores over its items plus one; it counts from `support` seeds or
    strings found. A seed scores 1 for its kind, an unseen string that may be of it one minus the product of its patterns' doubts;
    it is found when it reaches `score` and a pattern of at least `confidence` holds it, and stays so. New patterns enter
    with the strings found until none is new."""
    sown = settle(edges.filter("kind is not null").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n_seeds")), "sown")
    sizes = settle(edges.groupBy("pattern").agg(F.count_distinct("item").alias("n_items")), "sizes")
    every = edges.filter("kind is null").select("pattern", "item", "may")
    can = F.getbit(F.col("may").cast("long"), F.col("kind")) == 1
    rated, n_rated, items, found = settle(sown.filter(F.col("n_seeds") >= support).join(sizes, "pattern"), "patterns"), -1, None, None
    while (n := rated.count()) != n_rated:
        n_rated = n
        unseen = settle(every.join(rated.select("pattern").distinct(), "pattern", "left_semi"), "unseen")
        gathered = lambda: unseen.join(items, "item").groupBy("pattern", "kind").agg(F.sum("score").alias("more"))  # noqa: B023, E731
        extra = gathered() if items is not None else None
        for _ in range(rounds):
            total = F.col("n_seeds") + (F.coalesce("more", F.lit(0.0)) if extra is not None else F.lit(0.0))
            p = rated if extra is None else rated.join(extra, ["pattern", "kind"], "left")
            patterns = settle(p.select("pattern", "kind", (total / (F.col("n_items") + 1)).alias("confidence")), "confidence")
            doubt = F.sum(F.log(1 - F.least("confidence", F.lit(0.99))))
            held = unseen.join(patterns, "pattern").filter(can).groupBy("item", "kind")
            items = settle(held.agg((1 - F.exp(doubt)).alias("score"), F.max("confidence").alias("best")), "scores")
            extra = gathered()
        now = items.filter((F.col("score") >= score) & (F.col("best") >= confidence)).select("item", "kind")
        found = settle((now if found is None else now.unionByName(found)).distinct(), "found")
        met = every.join(found, "item").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n_found"))
        backed = met.join(sown, ["pattern", "kind"], "full").na.fill(0, ["n_found", "n_seeds"]).filter(F.col("n_found") + F.col("n_seeds") >= support)
        rated = settle(backed.select("pattern", "kind", "n_seeds").join(sizes, "pattern"), "patterns")
    return patterns, items


def extract(docs: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8, score: float = 0.95) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone (seeds), base_sha256 (of the seeds), spans (all),
    n_found (spans that only the patterns found).

    Spans are kind:start:end in code points, by start, then kind. A candidate is found if a pattern of at least
    `confidence` in a kind holds it and its score for that kind reaches `score`; found spans of a kind do not overlap. Null and empty texts have no spans;
    repeated rows have equal results; an empty table gives no rows. Other columns are ignored.
    """
    at = settle(scan(docs), "occurrences")
    one = at.select("row", F.explode(F.arrays_zip("o_start", "o_end", "o_kind", "o_text", "o_patterns", "o_may")).alias("o")).select(
        "row", "o.o_start", "o.o_end", F.when(F.col("o.o_kind") >= 0, F.col("o.o_kind")).alias("kind"), F.col("o.o_text").alias("item"), F.col("o.o_may").alias("may"),
        F.explode(F.split("o.o_patterns", "\x1f")).alias("pattern"))
    one = settle(one, "candidates")
    edges = settle(one.select("pattern", "item", "kind", F.when(F.col("kind").isNull(), F.col("may")).alias("may")).distinct(), "edges")
    seen = edges.filter("kind is not null").select("item").distinct()
    # A string that is a seed anywhere is not an unseen one elsewhere.
    edges = edges.filter("kind is not null").unionByName(edges.filter("kind is null").join(seen, "item", "left_anti"))
    patterns, items = score_graph(settle(edges, "graph"), rounds, support, confidence, score)
    found = one.filter("kind is null").drop("kind").join(patterns.filter(F.col("confidence") >= confidence), "pattern").filter(
        F.getbit(F.col("may").cast("long"), F.col("kind")) == 1)
    sure = items.filter(F.col("score") >= score).select("item", "kind").unionByName(
        one.filter("kind is not null").select("item", "kind").distinct())
    bare = F.min(F.col("pattern").rlike(r"^(before|behind|around)\|")).alias("bare")
    found = found.join(sure.distinct(), ["item", "kind"], "left_semi").groupBy("row", "o_start", "o_end", "kind").agg(bare)
    # Of overlapping spans of a kind one stays: rather one whose form speaks for it than one by words alone, then the first, then the longest.
    ranked = F.array_sort(F.collect_list(F.struct("bare", "o_start", (-F.col("o_end")).alias("o_back"), "kind")))
    spans = found.groupBy("row").agg(F.aggregate(ranked, F.array().cast("array<struct<b_start:int,b_kind:int,b_end:int>>"), lambda kept, x: F.when(
        F.exists(kept, lambda y: (y["b_kind"] == x["kind"]) & (y["b_start"] < -x["o_back"]) & (x["o_start"] < y["b_end"])), kept).otherwise(
        F.concat(kept, F.array(F.struct(x["o_start"].alias("b_start"), x["kind"].alias("b_kind"), (-x["o_back"]).alias("b_end")))))).alias("more"))
    out = at.select("doc_id", "row", "base_sha256", "b_start", "b_kind", "b_end").join(spans, "row", "left")
    base = F.arrays_zip("b_start", "b_kind", "b_end")
    every = F.array_sort(F.concat(base, F.coalesce("more", F.array().cast("array<struct<b_start:int,b_kind:int,b_end:int>>"))))
    name = F.array(*[F.lit(k) for k in KINDS])
    said = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.get(name, s["b_kind"]), s["b_start"], s["b_end"])), ",")
    count = lambda k: F.size(F.filter("b_kind", lambda x: x == k)).cast("long")
    return out.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)], "base_sha256", said.alias("spans"),
                      F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"))
