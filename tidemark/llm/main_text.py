"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

Each leaf block (``dom``) has features of the elements around it (tags, and words of their class, id and
role) and of its text (length, share of links, punctuation, usual phrases). The field is trained on labelled
pages (``page_samples`` unless others are given) and Viterbi decoding picks the blocks of the main text
together, so a short line between paragraphs is kept and a long advert between menus is not.

Pages are worked through row by row, whole, in any partition alone. A null or empty page, and one without
readable text, gives the empty text; a very long page takes memory in proportion to its own length. Repeated
rows and null ids pass through. Columns are picked by name, so others may have any name; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crf import Chain, fit
from tidemark.llm.dom import CONTEXT, HINT_OF, HINTS, Block, Open, blocks
from tidemark.llm.page_samples import PHRASES, labelled_pages

#: Labelled pages of a training run, and the seed that makes them.
PAGES, SEED = 800, 13
#: Upper ends of the buckets of a block's length in words, and of the share of its text in links.
WORDS, LINKED = (1, 2, 4, 7, 12, 25, 60), (0.0, 0.2, 0.5, 0.8)
#: Rows of an output batch.
CHUNK = 64

_TEXT = (
    [f"words{k}" for k in range(len(WORDS) + 1)] + [f"linked{k}" for k in range(len(LINKED) + 1)] + [f"phrase:{k}" for k in PHRASES]
    + ["bias", "sentence", "sentences", "comma", "capitals", "digits", "sign", "breaks", "after title", "outside", "first", "last", "short unended"]
)
FEATURES = {
    name: k
    for k, name in enumerate([f"in:{t}" for t in sorted(CONTEXT)] + [f"at:{t}" for t in sorted(CONTEXT)] + [f"hint:{w}" for w in HINT_OF] + [f"hints:{k}" for k in HINTS] + _TEXT)
}
_KNOWN = [(FEATURES[f"phrase:{kind}"], [p.rstrip(".!?").lower() for p in listed.split("|") if len(p) > 4]) for kind, listed in PHRASES.items()]
_LONGEST_PHRASE = 200


def context(around: Open) -> list[int]:
    """Features of the elements around a block."""
    found = [FEATURES[f"in:{t}"] for t in around.tags] + [FEATURES[f"hint:{w}"] for w in around.words]
    if around.tag in CONTEXT:
        found.append(FEATURES[f"at:{around.tag}"])
    return found + [FEATURES[f"hints:{k}"] for k in {HINT_OF[w] for w in around.words}]


_F = {name: FEATURES[name] for name in _TEXT}


def of_text(block: Block) -> list[int]:
    """Features of a block's text."""
    text = block.text
    words = text.count(" ") + 1
    found = [_F["bias"], _F["words0"] + sum(words > w for w in WORDS), _F["linked0"] + sum(block.linked / len(text) > x for x in LINKED)]
    ended = text[-1] in ".!?\u2026\"\u201d\u00bb:;"
    if ended:
        found.append(_F["sentence"])
    elif words < 8:
        found.append(_F["short unended"])
    if text.count(". ") + text.count("? ") + text.count("! "):
        found.append(_F["sentences"])
    if ", " in text:
        found.append(_F["comma"])
    if block.breaks > 1:
        found.append(_F["breaks"])
    if len(text) <= _LONGEST_PHRASE:  # what menus, notices and footers say is short
        if text.isupper():
            found.append(_F["capitals"])
        if sum(map(str.isdigit, text)) * 3 > len(text):
            found.append(_F["digits"])
        if any(c in text for c in "\u00a9|\u00b7\u00bb\u00ae"):
            found.append(_F["sign"])
        low = text.lower()
        found += [k for k, listed in _KNOWN if any(p in low for p in listed)]
    return found


def of_page(found: Sequence[Block]) -> list[list[int]]:
    """Features of each block that depend on the blocks around it."""
    out: list[list[int]] = [[] for _ in found]
    main = ["article" in b.around.tags or "main" in b.around.tags for b in found]
    some, titled = any(main), False
    for k, b in enumerate(found):
        if titled:
            out[k].append(_F["after title"])
        titled = titled or "h1" in b.around.tags
        if some and not main[k]:
            out[k].append(_F["outside"])
    if found:
        out[0].append(_F["first"])
        out[-1].append(_F["last"])
    return out


@dataclass
class Extractor:
    """A trained field; ``extract`` gives the main text of a page."""

    chain: Chain

    def scores(self, found: Sequence[Block]) -> list[float]:
        w, out = self.chain.weights.tolist(), []
        for b, more in zip(found, of_page(found)):
            if b.around.score is None:  # once for all blocks of an element
                b.around.score = sum(w[i] for i in context(b.around))
            out.append(b.around.score + sum(w[i] for i in of_text(b)) + sum(w[i] for i in more))
        return out

    def extract(self, html: str) -> str:
        found = list(blocks(html))
        labels = self.chain.viterbi(self.scores(found))
        return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def train(pages: Iterable[str]) -> Extractor:
    """Fit the field on labelled pages; blocks without a label count as 0."""
    features, labels = [], []
    for html in pages:
        found = list(blocks(html))
        if found:
            features.append([context(b.around) + of_text(b) + more for b, more in zip(found, of_page(found))])
            labels.append([b.around.label or 0 for b in found])
    return Extractor(fit(features, labels, len(FEATURES)))


@lru_cache(maxsize=1)
def default_extractor() -> Extractor:
    """Trained on ``PAGES`` composed pages, the same each time."""
    return train(labelled_pages(PAGES, SEED))


def extract_main_text(pages: DataFrame, extractor: Extractor | None = None, keep: Sequence[str] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The ``keep`` columns of every page, ``text`` and ``n_chars`` (its code points)."""
    model = extractor or default_extractor()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                texts = [model.extract(x.as_py() or "") for x in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    rows = pages.select(*keep, pages[html].cast("string").alias("html"))
    return rows.mapInArrow(work, f"{fields}, text string").withColumn("n_chars", F.length("text").cast("long"))
