"""Personal data: patterns with checks, and terms that give protected values away.

The patterns find e-mail addresses, IPv4 addresses, card numbers and telephone numbers. Their values
are the protected entities. All terms of an entity's documents are then weighed by what the corpus
says: with N documents, the information content of entity e is IC(e) = ln(N / n(e)), and what term t
tells of it is PMI(e, t) = ln(N n(e, t) / (n(e) n(t))). Where PMI / IC reaches the disclosure
threshold, t says nearly as much as the value itself; its occurrences in all documents become spans
of kind ``term``, provided that e and t meet in documents of at least ``support`` different texts
(copies of a whole text count once). ``sanitise`` generalises such terms by a given taxonomy and
removes the others.

n(e), n(t), n(e, t) and N count all documents. Terms are runs of letters and digits outside values.
Spans are (start, end) in code points. Null and empty texts have none; ids pass through, null and
repeated ones too; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_of
from tidemark.session import checkpoint_root, scratch_path

#: The base kinds, in the order of their listing; terms come after them.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails does so from each of its digits, so only its first one is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")

#: Places of the bitmap of disclosing terms, and words that a worker remembers.
SLOTS, REMEMBER = 1 << 20, 400_000
#: Share of an entity's information that makes a term disclosing, and the different texts it takes.
DISCLOSURE, SUPPORT = 0.9, 3


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping. Looks at each @ in turn, so long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def personal_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the base kinds, in that order."""
    out = [(0, *span) for span in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def _number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Words that touch no value, with their places."""
    values, k = sorted((a, b) for _, a, b in spans), 0
    # Values of different kinds can overlap; the end that counts is the largest so far.
    ends, far = [], 0
    for _, b in values:
        far = max(far, b)
        ends.append(far)
    for m in _TERM.finditer(text):
        while k < len(values) and ends[k] <= m.start():
            k += 1
        if k == len(values) or m.end() <= values[k][0]:
            yield m.group().lower(), m.start(), m.end()


def _terms(text: str, spans: list[tuple[int, int, int]]) -> set[str]:
    return {t for t, _, _ in _words_outside(text, spans)} if spans else {t.lower() for t in set(_TERM.findall(text))}


def _entities(text: str, spans: list[tuple[int, int, int]]) -> set[int]:
    return {_number(f"{k}:{text[a:b].lower() if k < 2 else re.sub(r'[^0-9]', '', text[a:b])}") for k, a, b in spans}


_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        spans = [personal_spans(t) for t in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], _SPAN),
            pa.array([_number(t) for t in texts], pa.int64()),
            pa.array([list(_entities(t, s)) for t, s in zip(texts, spans)], pa.list_(pa.int64())),
            pa.array([sorted(_terms(t, s)) if s else [] for t, s in zip(texts, spans)], pa.list_(pa.string())),
        ], names=["id", "base", "key", "entities", "terms"])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents of this batch that have it outside values)."""
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(_terms(text, personal_spans(text)))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])


def disclosing_terms(staged: DataFrame, texts: DataFrame, threshold: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(entity, term) pairs whose term tells at least ``threshold`` of the entity's information."""
    n = F.lit(float(staged.count()))
    content = F.log(n / F.col("n_entity"))

    def told(both: Column) -> Column:
        return F.log(n * both / (F.col("n_entity") * F.col("n_term"))) >= threshold * content

    held = staged.select("key", F.explode("entities").alias("entity")).groupBy("key", "entity").agg(F.count("*").alias("copies")).checkpoint()
    of_entity = held.groupBy("entity").agg(F.sum("copies").alias("n_entity"), F.count("*").alias("texts")).filter((F.col("texts") >= support) & (content > 0))
    live = held.join(of_entity.select("entity", "n_entity").checkpoint(), "entity").checkpoint()
    of_term = texts.mapInArrow(_document_counts, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n_term")).filter(F.col("n_term") >= support).checkpoint()
    words = staged.join(live.select("key").distinct().checkpoint(), "key", "left_semi").select("key", F.explode("terms").alias("term")).distinct()
    # No pair meets more often than its rarer side stands, so what fails with that number fails anyway.
    met = words.join(of_term, "term").join(live, "key").filter(told(F.least("n_entity", "n_term")))
    counted = met.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_both"))
    return counted.filter((F.col("texts") >= support) & told(F.col("n_both"))).select("entity", "term").checkpoint()


def _slot(term: str) -> int:
    return _number(term) % SLOTS


def _occurrences(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, terms): per different text, the spans of all occurrences of ``terms`` (column term).

    A bitmap of at most ``SLOTS`` entries goes to every worker and lets few other words pass; a join settles those.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_slot(t) for t in batch.column(0).to_pylist()], pa.int64())], names=["slot"])

    shared = texts.sparkSession.sparkContext.broadcast(frozenset(r.slot for r in terms.mapInArrow(slots, "slot bigint").distinct().collect()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            if len(known) > REMEMBER:
                known.clear()
            out = []
            for text in batch.column(0).to_pylist():
                some = set(_TERM.findall(text))
                for w in some.difference(known):
                    known[w] = _slot(w.lower()) in shared.value
                if any(map(known.__getitem__, some)):
                    key = _number(text)
                    out += [(key, t, a, b) for t, a, b in _words_outside(text, personal_spans(text)) if known[text[a:b]]]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int32()))], names=["key", "term", "start", "end"])

    found = texts.mapInArrow(find, "key bigint, term string, start int, end int").distinct().join(terms, "term", "left_semi")
    span = F.struct(F.lit(KINDS.index("term")).alias("kind"), "start", "end")
    return found.groupBy("key").agg(F.collect_list(span).alias("found")).checkpoint()


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = DISCLOSURE, support: int = SUPPORT, keep_text: bool = False) -> DataFrame:
    """Per row: id and ``spans``: array<struct<kind, start, end>>, by kind, then start.

    The first pass is written below the shared folder, with the terms of documents that have an entity.
    Rows meet the terms found in them by a hash of their text. The texts are not shuffled.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    texts = docs.select(text_of(docs, text_col).alias("text"))
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    id_type = rows.schema[0].dataType.simpleString()
    spans = "array<struct<kind:int,start:int,end:int>>"

    def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = next(_scan(iter([batch])))
            yield pa.RecordBatch.from_arrays([*found.columns, batch.column(1)], names=[*found.schema.names, "text"])

    path = scratch_path(spark, "pii")
    schema = f"id {id_type}, base {spans}, key bigint, entities array<bigint>, terms array<string>" + ", text string" * keep_text
    rows.mapInArrow(with_text if keep_text else _scan, schema).write.parquet(path)
    staged = spark.read.parquet(path)
    terms = disclosing_terms(staged, texts, threshold, support).select("term").distinct().checkpoint()
    joined = staged.drop("entities", "terms").join(_occurrences(texts, terms), "key", "left")
    all_spans = F.when(F.col("found").isNull(), F.col("base")).otherwise(F.concat("base", F.sort_array("found")))
    return joined.select(F.col("id").alias(id_col), all_spans.alias("spans"), *["text"] * keep_text)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: list[tuple[int, int, int]], taxonomy: Mapping[str, str]) -> str:
    """``text`` with values replaced by their kind, terms by their more general term or nothing."""
    out, done = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start < done:
            start = done
        if end <= start:
            continue
        out += [text[done:start], taxonomy.get(text[start:end].lower(), "") if KINDS[kind] == "term" else f"[{KINDS[kind]}]"]
        done = end
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, taxonomy: Mapping[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: id and its text without personal data and disclosing terms."""
    general = dict(taxonomy or {})
    found = find_personal_data(docs, id_col, text_col, keep_text=True, **options)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(1).to_pylist())
            texts = [masked(t, [(s["kind"], s["start"], s["end"]) for s in spans], general) for t, spans in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return found.mapInArrow(mask, f"`{id_col}` {found.schema[0].dataType.simpleString()}, text string")
