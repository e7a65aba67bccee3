"""Mixing, language-model scores and toxicity: brute force, exact properties, held-out accuracy."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001, SF01
from tidemark.llm import lm, mixing, queries, toxicity
from tidemark.llm.attention import BACK, LENGTH, STEP, Attention, averaged
from tidemark.llm.bpe import Encoder, Vocabulary, byte_alphabet
from tidemark.llm.merges import WordMerges

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType()), ("size", T.StringType()), ("row", T.LongType()), ("draw", T.StringType()))])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, "y") for i, t, s in rows], SCHEMA)


# mixing

def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Sharing again and again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    rest, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        level = rest / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not above:
            return full | {s: level * weight[s] for s in free}
        for s in above:
            full[s] = cap * sizes[s]
            rest -= full[s]


MIXED = [(k, "w " * (1 + k * 7 % 50), f"s{k % 5}") for k in range(200)] + [(500 + k, "big " * 40, "hot") for k in range(300)]
MIXED += [(900, "one two", None), (901, None, None), (None, "a null id", "é"), (902, "", "empty"), (903, "x\x0by\x85z", "𝒳"), (0, "w ", "s0"), (0, "w ", "s0"), (904, "y " * 30_000, "long")]


def size(text):
    return len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w])


def test_mix(spark):
    got = mixing.mix(frame(spark, MIXED).repartition(3)).collect()
    assert len(got) == len(MIXED)
    sizes = Counter()
    for _, t, s in MIXED:
        sizes[s] += size(t)
    want = targets_by_hand(sizes)
    by_row = {(i, t): s for i, t, s in MIXED}
    texts = {}
    for i, t, s in MIXED:
        texts.setdefault(i, []).append((size(t), s))
    took = Counter()
    for r in got:
        s = next(s for n, s in texts[r.doc_id] if n == r["size"] and sizes[s] == r.source_size)
        assert r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r["size"] and sum(c.taken for c in r.copies) == r.taken
        took[s] += r.taken
    assert all(abs(took[s] - want[s]) <= 0.5 for s in want) and by_row


def test_mix_is_the_same_however_the_rows_lie(spark):
    rows = {tuple(r[:6]) for r in mixing.mix(frame(spark, MIXED)).collect()}
    assert rows == {tuple(r[:6]) for r in mixing.mix(frame(spark, MIXED[::-1]).repartition(7)).collect()}


def test_mix_of_an_empty_table(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.training_order(frame(spark, [])).count() == 0


def test_what_is_taken_is_the_sum_of_the_curriculums_steps(spark):
    """At the end of each step every source has given the integral of its schedule, in words of its target."""
    def integral(t, schedule, n=4000):
        x = (np.arange(n) + 0.5) / n
        w = np.interp(x, [p[0] for p in schedule], [p[1] for p in schedule])
        return w[x < t].sum() / w.sum()

    got = mixing.mix(frame(spark, MIXED), steps=8).collect()
    by_row = {(i, size(t)): s for i, t, s in MIXED}
    sources = sorted({s for _, _, s in MIXED}, key=lambda s: (s is None, (s or "").encode()))
    gave, target = {s: np.zeros(8) for s in sources}, {}
    for r in got:
        s = by_row[r.doc_id, r["size"]]
        assert len(r.by_step) == 8 and min(r.by_step) >= 0 and sum(r.by_step) == r.taken == sum(c.taken for c in r.copies)
        gave[s] += r.by_step
        target[s] = r.target
    for k, s in enumerate(sources):
        want = [target[s] * integral((j + 1) / 8, mixing.SCHEDULES[k % 3]) for j in range(8)]
        assert gave[s].cumsum() == pytest.approx(want, abs=0.5 + 1e-3 * target[s]), s
    plan = queries.op2_mix(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert f"{mixing.demanded(1 / mixing.STEPS, mixing.SCHEDULES[0])}"[:8] in plan


def test_the_query_places_every_copy_in_the_training(spark, monkeypatch):
    """What ``op2_mix`` returns is read from the sequence of copies, so no part of their placing may be left out."""
    def never(part, schedule):
        return F.raise_error(F.lit("a moment was asked for")).cast("double")

    with monkeypatch.context() as m:
        m.setattr(mixing, "moment", never)
        with pytest.raises(Exception, match="a moment was asked for"):
            queries.op2_mix(spark, SF001).collect()
    sequences = []
    with monkeypatch.context() as m:
        m.setattr(mixing, "training_sequence", lambda plan, made=mixing.training_sequence: sequences.append(made(plan)) or sequences[-1])
        got = queries.op2_mix(spark, SF001).collect()
    assert len(sequences) == 1 and sum(r.taken for r in sequences[0].collect()) == sum(r.taken for r in got) > 0


def test_the_sequence_is_the_training_order(spark):
    """Each copy begins where the words of the copies before it end; rows without copies stay in the mix."""
    got = mixing.mix(frame(spark, MIXED).repartition(3)).collect()
    copies = sorted((c.position, r.key, c["pass"], c.since, c.taken) for r in got for c in r.copies)
    whole = 0
    for k, (*_, since, taken) in enumerate(copies):
        if copies[k][:3] != copies[k - 1][:3]:  # equal rows stand side by side, either one first
            assert since == whole
        whole += taken
    assert whole == sum(r.taken for r in got) and sorted(c[3] for c in copies)[-1] < whole
    assert any(not r.copies and r.taken == 0 for r in got) and len(got) == len(MIXED)


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_moments_invert_the_integral(spark, schedule):
    def integral(t, steps=20_000):
        x = (np.arange(steps) + 0.5) / steps
        w = np.interp(x, [p[0] for p in schedule], [p[1] for p in schedule])
        return w[x < t].sum() / w.sum()

    parts = spark.createDataFrame([(k / 20,) for k in range(21)], "part double")
    for r in parts.select("part", mixing.moment(F.col("part"), schedule).alias("at")).collect():
        assert integral(r["at"]) == pytest.approx(r.part, abs=2e-4)


def test_training_order(spark):
    docs = frame(spark, [r for r in MIXED if r[0] is not None])
    plan = {(r.doc_id, r.size): r for r in mixing.mix(docs).collect()}
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    rows = ordered.collect()
    times = Counter((r.doc_id, size(r.text)) for r in rows if r.doc_id)
    for key, r in plan.items():
        if key[0]:
            assert times[key] == sum(2 * c.taken >= r["size"] for c in r.copies), key
    place = {(i, c["pass"]): c.position for (i, _), r in plan.items() for c in r.copies}
    seen = Counter()
    at = []
    for r in rows:
        if r.doc_id:  # 0 stands there twice
            at.append(place[r.doc_id, seen[r.doc_id]])
            seen[r.doc_id] += 1
    assert at == sorted(at)


# attention

def naive(model, sequence):
    """Each token alone, from its own window, one place at a time."""
    p, total = model.p, 0.0
    filled = [model.classes] + list(sequence[:-1])
    for t, goal in enumerate(sequence):
        low = t // STEP * STEP - BACK
        x = [p["embed"][filled[s]] + p["place"][s - low] for s in range(max(0, low), t + 1)]
        q = x[-1] @ p["q"]
        a = np.array([q @ (y @ p["k"]) for y in x], np.float64) / math.sqrt(len(q))
        a = np.exp(a - a.max())
        mixed = sum(w * (y @ p["v"]) for w, y in zip(a / a.sum(), x))
        h = x[-1] + mixed @ p["o"]
        z = h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"]
        logits = z @ p["out"] + p["bias"]
        total += logits[goal] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    return total


def test_windows_score_each_token_once():
    rng = np.random.default_rng(0)
    model = Attention(20)
    sequences = [rng.integers(0, 20, n) for n in (1, 5, STEP, STEP + 1, LENGTH, 3 * LENGTH + 7, 500)]
    targets, owner = model.windows(sequences)[1:]
    for k, s in enumerate(sequences):
        assert np.array_equal(targets[owner == k][targets[owner == k] >= 0], s)
    assert model.score(sequences, batch=3) == pytest.approx([naive(model, s) for s in sequences], rel=1e-4)
    assert np.exp(model.log_probabilities(model.windows(sequences)[0])).sum(2) == pytest.approx(1, abs=1e-4)


def test_later_tokens_change_nothing():
    rng = np.random.default_rng(1)
    model, s = Attention(20), rng.integers(0, 20, 70)
    changed = s.copy()
    changed[40:] = (changed[40:] + 1) % 20
    a, b = (model.log_probabilities(model.windows([x])[0]).reshape(-1, 20) for x in (s, changed))
    assert a[:41] == pytest.approx(b[:41]) and not np.allclose(a[41:70], b[41:70])


def test_gradients():
    rng = np.random.default_rng(2)
    model = Attention(9)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    inputs, targets, _ = model.windows([rng.integers(0, 9, 60), rng.integers(0, 9, 3)])
    _, grads = model.gradients(inputs, targets)
    for name, value in model.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            was, ends = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = was + step
                ends.append(model.gradients(inputs, targets)[0])
            value[at] = was
            assert grads[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=2e-4), name


def test_grouped_outputs_have_right_gradients_and_sum_to_one():
    rng = np.random.default_rng(4)
    model = Attention(12, rng.dirichlet(np.ones(12)), groups=3)
    sequences = [rng.integers(0, 12, n) for n in (60, 3, 0, 40)]
    inputs, targets, _ = model.windows(sequences)
    whole = model.log_probabilities(inputs)
    assert np.exp(whole).sum(2) == pytest.approx(1, abs=1e-5)
    picked = [whole.reshape(-1, 12)[k, t] for k, t in enumerate(targets.ravel()) if t >= 0]
    assert model.each(sequences, batch=2) == pytest.approx(picked, rel=1e-4)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grads = model.gradients(inputs, targets)
    for name in ("out", "bias", "group", "group_bias", "embed", "w2"):
        value = model.p[name]
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            was, ends = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = was + step
                ends.append(model.gradients(inputs, targets)[0])
            value[at] = was
            assert grads[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=2e-4), name


def test_training_holds_a_chunk_and_sees_every_sequence():
    rng, asked = np.random.default_rng(5), []
    model, sequences = Attention(9), [rng.integers(0, 9, 100) for _ in range(30)]
    windows = model.windows
    model.windows = lambda some: asked.append(len(some)) or windows(some)
    assert model.train(iter(sequences), steps_at_least=1, chunk=20) == 3000
    assert sum(asked) == 30 and max(asked) == 5  # four windows each


def test_training_lowers_the_loss_and_models_average():
    rng = np.random.default_rng(3)
    follow = rng.permutation(30)
    sequences = []
    for _ in range(40):
        s = [int(rng.integers(30))]
        for _ in range(60):
            s.append(int(follow[s[-1]]) if rng.random() < 0.8 else int(rng.integers(30)))
        sequences.append(np.array(s))
    model = Attention(30)
    before = model.score(sequences).sum()
    model.train(iter(sequences), steps_at_least=200)
    assert model.score(sequences).sum() > 0.6 * before
    mean = Attention(30).unpack(averaged([(1.0, model.packed()), (3.0, model.packed())]))
    assert mean.score(sequences[:3]) == pytest.approx(model.score(sequences[:3]), rel=1e-3)


# language model

lm_bytes = {c: b for b, c in enumerate(byte_alphabet())}


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def base_by_hand(rows):
    held = {k: crc32(str("" if i is None else i).encode()) % 10 == 0 for k, (i, _) in enumerate(rows)}
    counts = Counter(w for k, (_, t) in enumerate(rows) if not held[k] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return sorted((
        (i, held[k], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 5))
        for k, (i, t) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("head", [5, 200_000])
def test_lm_base(spark, head):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(None, "null id"), (5001, None), (5002, ""), (5003, "unseen unseen zzzz é"), (5004, "word " * 30_000), (0, "again"), (0, "again")]
    got = lm.score_documents(frame(spark, [(i, t, "s") for i, t in rows]), Vocabulary(public_tokenizers.path("word_bpe_49k.json")), queries.remainder("doc_id", 10) == 0, head=head, rounds=1).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=repr) == base_by_hand(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_tokens_mix_the_model_with_the_shares_of_frequent_words():
    shares = lm.Shares(np.array([2, 1, 1]), np.log([0.5, 1.0, 1.0]), np.log([0.3, 0.2, 0.1]))
    each = np.log([0.5, 0.4, 0.1, 0.2, 0.3, 0.25])  # word 0, a rare word of two ids, word 1, the end
    by_hand = [lm.MIX * 0.5 * 0.4 * 0.5 + (1 - lm.MIX) * 0.3, lm.MIX * 0.1 * 0.2, lm.MIX * 0.3 + (1 - lm.MIX) * 0.2, lm.MIX * 0.25 + (1 - lm.MIX) * 0.1]
    assert np.exp(shares.mixed(each, np.array([0, 2 + 2, 1]))) == pytest.approx(by_hand)
    assert np.exp(shares.mixed(each[-1:], np.array([], np.int64))) == pytest.approx(by_hand[-1:])


def test_words_are_whole_subword_sequences(spark):
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["The Caf\u00e9 unbelievableness qqqzzzxxx " + "x" * 3000, "", "the the"]
    corpus = lm.count_corpus(spark.createDataFrame([(t,) for t in texts[2:]], "text string"), vocabulary)
    reader = lm.Reader(type("Shared", (), {"value": corpus}))
    encoder = lm.Encoder(vocabulary)
    for text in texts:
        words, numbers = reader.read(text)
        ids = [k for w in words for k in encoder.piece(w.decode())]
        spelled = b"".join(bytes(lm_bytes[c] for c in vocabulary.tokens[k].removesuffix(vocabulary.mark)) for k in ids)
        assert spelled == b"".join(words)
        assert list(lm._sequence(reader.ids(numbers))) == [*corpus.own[ids], 0]


@pytest.fixture(scope="module")
def words():
    """Words of the given documents, random ones, and ones that repeat a letter or hold bytes of all kinds; some very long."""
    rng = np.random.default_rng(6)
    made = ["".join(rng.choice(list("aeinrst0_\u00e9\u0436\u6f22\U00010330"), n)) for n in rng.integers(1, 31, 2000)]
    made += [c * n for c in "a.=1\u00fc" for n in (1, 2, 3, 7, 16, 31, 32, 33, 500)] + ["un" + "believ" * 20 + "ably", ""]
    return [w.lower().encode() for w in made] + [bytes([b]) for b in range(0x21, 0x7F)]


def test_merging_many_words_equals_encoding_each(words):
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    encoder, shared = Encoder(vocabulary), type("Shared", (), {"value": vocabulary})
    want = [encoder.piece(w.decode()) if w else [] for w in words]
    for ids, counts in (WordMerges(vocabulary).encode(words), lm._subwords(words, shared)):
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [k for x in want for k in x]
    assert [len(x) for x in WordMerges(vocabulary).encode([])] == [len(x) for x in lm._subwords([], shared)] == [0, 0]


def test_new_words_of_a_batch_are_encoded_together(spark, words, monkeypatch):
    """One by one they took most of the time of reading; only long ones still are, and what a word gets is the same."""
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    corpus = lm.count_corpus(spark.createDataFrame([("the the of",)], "text string"), vocabulary)
    encoder, alone, together = Encoder(vocabulary), [], []
    piece, encode = Encoder.piece, WordMerges.encode
    monkeypatch.setattr(Encoder, "piece", lambda self, w: alone.append(w) or piece(self, w))
    monkeypatch.setattr(WordMerges, "encode", lambda self, some: together.append(len(some)) or encode(self, some))
    texts = [b" ".join([b"the", *words[a : a + 100], b"of", words[a]]).decode() for a in range(0, len(words), 100)]
    reader = lm.Reader(type("Shared", (), {"value": corpus}))
    read = reader.read_all(texts)
    assert alone and all(len(w.encode()) > lm.SHORT for w in alone) and len(together) == 1
    for text, (split, numbers) in zip(texts, read):
        ids = [piece(encoder, w.decode()) for w in split]
        assert split == lm.words_of(text) and list(lm._sequence(reader.ids(numbers))) == [*corpus.own[[k for x in ids for k in x]], 0]
        assert reader.sizes[numbers].tolist() == [len(x) for x in ids]
        assert reader.rare[numbers] == pytest.approx([corpus.rare[x].sum() for x in ids])
    assert reader.read_all(texts) == read and len(together) == 1


def test_a_worker_holds_one_encoder():
    """That of the counts goes when the texts are encoded."""
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    lm._encoder.cache_clear()
    for _ in range(2):
        lm._encoder(type("Shared", (), {"value": vocabulary}))
    assert lm._encoder.cache_info().currsize == 1
    lm._encoder.cache_clear()


def test_lm_without_rows_or_training(spark):
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    assert lm.score_documents(frame(spark, []), vocabulary, F.lit(False)).count() == 0
    row = lm.score_documents(frame(spark, [(1, "a b", "s")]), vocabulary, F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_lm_beats_counts_on_held_out_texts(spark):
    held = queries.op3_lm_score(spark, SF01).filter("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert held.score > held.base + 0.02 * held.n


@pytest.fixture(scope="module")
def one_document_a_slice(spark):
    """The corpus and a function that gives the model learnt from it, with the words of one document turned round."""
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(" ".join(f"the and of to in is that for it as was with {k}".split() * 3), k) for k in range(32)]

    def learnt(turned=None):
        return lm.train_model(spark.createDataFrame([(" ".join(t.split()[::-1]) if k == turned else t, k) for t, k in rows], "text string, draw long"), corpus)

    corpus = lm.count_corpus(spark.createDataFrame(rows, "text string, draw long").select("text"), vocabulary)
    return learnt, learnt()


@pytest.mark.parametrize("slice_", [0, 5, 18, 31])
def test_the_model_learns_from_documents_of_every_slice(one_document_a_slice, slice_):
    """Turning a document's words round leaves all counts as they are."""
    learnt, model = one_document_a_slice
    assert learnt() == model != learnt(turned=slice_)


# toxicity

def test_toxicity_learns_from_labels(spark):
    scored = queries.op9_toxicity(spark, SF01)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    found = scored.filter("held_out").join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id")
    toxic = [r.score for r in found.filter("toxic = 1").collect()]
    clean = [r.score for r in found.filter("toxic = 0").collect()]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.75
    assert np.mean([c >= 0.7 for c in clean]) < 0.1


def test_toxicity_scores_depend_on_the_text_alone():
    rng = np.random.default_rng(0)
    plain = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(plain, 40)) + (" awful" if k % 3 == 0 else "") for k in range(300)]
    model = toxicity.fit(texts, [int(k % 3 == 0) for k in range(300)], epochs=6)
    toxicity.calibrate(model, texts, [int(k % 3 == 0) for k in range(300)])
    scores = model.scores(texts)
    assert np.mean((scores >= 0.7) == (np.arange(300) % 3 == 0)) > 0.95
    assert model.scores(texts[::-1])[::-1] == pytest.approx(scores, abs=1e-5)
    long = " ".join(texts[k] for k in range(300) if k % 3) * 3
    assert model.scores([long + " awful"])[0] > model.scores([long])[0]
    assert all(0 <= s <= 1 for s in model.scores(["", " ", "é " * 50_000]))


def test_toxicity_convolution_by_hand():
    model, text = toxicity.Model.start(), "one two, three four five"
    words = toxicity.Words([text])
    x = [model.embed[words.rows[k]].sum(0) for k in words.texts[0]] + [np.zeros(toxicity.DIM)] * 2
    pooled = np.concatenate([np.max([sum(x[t + j] @ f[j] for j in range(len(f))) for t in range(5)], axis=0) for f in model.filters])
    assert model.logits(words)[0] == pytest.approx(float(np.maximum(pooled + model.bias, 0) @ model.out), rel=1e-4)


def test_toxicity_odd_rows(spark):
    docs = frame(spark, [(1, None, "s"), (2, "", "s"), (None, "bad", "s"), (3, "x " * 30_000, "s"), (3, "again", "s")])
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (None, 1), (3, None), (9, 5)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, toxicity.train(docs, labels)).count() == 5
    assert toxicity.train(docs, labels.filter("false")) is None
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.score_documents(frame(spark, []), None).count() == 0


@pytest.fixture(scope="module")
def labelled_words(spark):
    """8,000 texts; one in four is toxic and says so with a word of its hundred, which the others never have."""
    rng = np.random.default_rng(3)
    rows = [(k, " ".join([f"w{x}" for x in rng.integers(0, 200, 12)] + [f"bad{k % 100}" if k % 4 == 0 else "good"]), int(k % 4 == 0)) for k in range(8000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return table.select("doc_id", "text"), table.select("doc_id", "toxic")


def test_toxicity_learns_from_every_labelled_row(spark, labelled_words, monkeypatch):
    """What the tasks go through, and what the thresholds count, are all labelled rows."""
    docs, labels = labelled_words
    seen, counted = [], []
    whole, mean_rows = toxicity._round, toxicity._counted
    monkeypatch.setattr(toxicity, "_round", lambda rows, *a: seen.append(rows.count()) or whole(rows, *a))
    monkeypatch.setattr(toxicity, "_counted", lambda rows, model: counted.append(rows.count()) or mean_rows(rows, model))
    monkeypatch.setattr(toxicity, "CHUNK_CHARS", 1 << 17)
    model = toxicity.train(docs, labels, rounds=2, passes=2)
    held = sum(crc32(str(k).encode()) // 3 % toxicity.CALIBRATE == 0 for k in range(8000))
    assert seen == [8000 - held] * 2 and counted == [held]
    got = toxicity.score_documents(docs, model).join(labels, "doc_id").collect()
    assert np.mean([(r.score >= toxicity.CUT) == r.toxic for r in got]) > 0.97


def test_toxicity_rows_of_tasks_are_weighted_by_how_often_they_moved(spark):
    texts = spark.createDataFrame([("bad one", 1), ("good two", 0)] * 40, "text string, toxic int").repartition(4)
    learner = toxicity.Learner(toxicity.Model.start())
    before = learner.model.embed.copy()
    toxicity._round(texts, learner, np.ones(2), 0, 2)
    used = np.unique(toxicity.Words(["bad one", "good two"]).rows)
    moved = np.flatnonzero((learner.model.embed != before).any(1))
    assert len(moved) and set(moved) <= set(used) and not learner.model.embed[toxicity.ROWS].any()
    assert learner.model.scores(["bad one"])[0] > learner.model.scores(["good two"])[0]


def test_toxicity_thresholds_from_counts_equal_those_from_rows():
    rng = np.random.default_rng(6)
    logits = np.round(rng.normal(0, 2, 500) * 8) / 8
    toxic = (logits + rng.normal(0, 1, 500) > 1).astype(int)
    cells, place = np.unique(logits, return_inverse=True)
    n, hits = np.bincount(place), np.bincount(place, toxic).astype(int)
    assert toxicity.best_threshold(cells, hits, n) == toxicity.best_threshold(logits, toxic)
