"""Secrets in texts: regex rules behind an inverted index of trigrams.

1. Every rule's pattern gives a Boolean trigram query (``trigrams.trigram_query``).
2. The index has a posting (trigram, document) for each trigram of the queries that a text contains,
   case folded. Other trigrams are in no query, so they get no postings.
3. Postings are intersected: per document, rule and alternative the bits of the trigrams found are
   or-ed; where all bits are set, the document is a candidate for the rule.
4. Candidates are verified by running the rule's regex over the whole text. A rule without mandatory
   trigrams runs over every text.

Spans are (start, end) in code points, leftmost and non-overlapping per kind. Null and empty texts
have no spans. Postings and candidates are keyed by the document id, or by a hash of the text where
the id is null; rows that share an id also share candidates, which the verification settles per row.
An empty table gives an empty result. All steps are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm.columns import let, text_of
from tidemark.llm.trigrams import trigram_query


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret: ``pattern`` in Java's syntax; the text of ``group`` needs ``least`` characters.

    ``query`` is the pattern as Python reads it, where the two differ (flags).
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    query: str | None = None


#: The base kinds, in the order of their listing.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6,
        query=r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=20),
    # Runs of fewer than 24 characters fail as a whole, so asking for 24 finds the same spans.
    SecretRule("hex", r"[0-9a-f]{24,}", least=24),
)
#: Kinds that the method adds: published shapes of well-known credentials.
MORE_RULES = (
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    SecretRule("npm", r"npm_[A-Za-z0-9]{36}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("webhook", r"https://hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    SecretRule("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}"),
    SecretRule("login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{3,100}@"),
)
RULES = BASE_RULES + MORE_RULES


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
_NONE = f"cast(array() as {_SPANS})"
#: Matches whose offsets are summed up in one array.
CHUNK = 256


def trigram_index(docs: DataFrame, vocabulary: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (trigram, key) of the trigrams in ``vocabulary``."""
    grams = F.array(*[F.lit(g) for g in vocabulary])
    found = let(F.lower(F.col("text")), lambda low: F.filter(grams, lambda g: F.contains(low, g)))
    return keyed(docs, id_col, text_col).select(F.explode(found).alias("trigram"), "key")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key): whole numbers are their own key, other ids and null have a hash. Rows that share a
    key share their candidate rules, which are verified on each text anyway."""
    text, id = text_of(docs, text_col), docs[id_col]
    own = id.cast("long") if isinstance(docs.schema[id_col].dataType, IntegralType) else F.when(id.isNotNull(), F.xxhash64(id.cast("string")))
    return docs.select(id.alias("id"), text.alias("text"), F.coalesce(own, F.xxhash64(text)).alias("key"))


def candidates(docs: DataFrame, rules: Sequence[SecretRule], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """(key, rules: numbers of the rules whose query the document fulfils); the rules that scan fully.

    The clauses that are broadcast have one row per rule, alternative and trigram: the size of the
    rule list, whatever the data.
    """
    clauses, full = [], []
    for k, rule in enumerate(rules):
        query = trigram_query(rule.query or rule.pattern)
        if query is None or any(len(grams) > 62 for grams in query):
            full.append(k)
            continue
        for a, grams in enumerate(query):
            clauses += [(g, k, a, 1 << i, (1 << len(grams)) - 1) for i, g in enumerate(sorted(grams))]
    if not clauses:
        return docs.sparkSession.createDataFrame([], "key long, rules array<int>"), full
    asked = docs.sparkSession.createDataFrame(clauses, "trigram string, rule int, alternative int, bit long, all_bits long")
    postings = trigram_index(docs, sorted({c[0] for c in clauses}), id_col, text_col)
    met = (
        postings.join(F.broadcast(asked), "trigram")
        .groupBy("key", "rule", "alternative", "all_bits").agg(F.bit_or("bit").alias("bits"))
        .filter("bits = all_bits")
    )
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules")), full


def spans_of(text: Column, rule: SecretRule, order: int) -> Column:
    """array<struct<start, rank, end, kind>> of one rule's matches.

    The pieces between the matches and the matches themselves give the offsets.
    """
    pattern = F.lit(rule.pattern)

    def located(found: Column) -> Column:
        """Offsets of the matches, in chunks: an array is copied when an item is added, so no array may
        grow with the number of matches."""
        chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0)), F.lit(CHUNK)), lambda k: F.slice(found, k + 1, CHUNK))

        def step(state: Column, m: Column) -> Column:
            begin = state["at"] + m["gap"]
            end = begin + m["size"]
            span = F.array(F.struct(begin.alias("start"), F.lit(order).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")))
            return F.struct(end.alias("at"), F.when(m["group"] >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

        def chunk(state: Column, part: Column) -> Column:
            done = F.aggregate(part, F.struct(state["at"].alias("at"), F.expr(_NONE).alias("spans")), step)
            return let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["parts"], F.array(d["spans"])).alias("parts")))

        start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_SPANS}>)").alias("parts"))
        return F.flatten(F.aggregate(chunks, start, chunk, lambda state: state["parts"]))

    gaps = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    found = let(F.struct(gaps.alias("gaps"), groups.alias("groups")), lambda x: F.transform(
        matches, lambda m, k: F.struct(F.length(F.get(x["gaps"], k)).alias("gap"), F.length(m).alias("size"), F.length(F.get(x["groups"], k)).alias("group"))))
    none = F.expr(_NONE)
    return F.when(text.rlike(rule.pattern), let(found, located)).otherwise(none)


def find_secrets(docs: DataFrame, rules: Sequence[SecretRule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``spans``: array<struct<start, rank, end, kind>> by start, then rule order."""
    by_key, full = candidates(docs, rules, id_col, text_col)
    rows = keyed(docs, id_col, text_col).join(by_key, "key", "left")
    none = F.expr(_NONE)
    parts = [
        spans_of(F.col("text"), rule, k) if k in full
        else F.when(F.array_contains("rules", k), spans_of(F.col("text"), rule, k)).otherwise(none)
        for k, rule in enumerate(rules)
    ]
    return rows.select(F.col("id").alias(id_col), F.sort_array(F.concat(*parts)).alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
