"""The language model against plain counting, a plain recurrence and numerical gradients."""

import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from odd import no_rows, odd_rows

from oreworks.llm import queries, recurrent

WHITE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return [w.encode() for w in WHITE.split((text or "").translate(LOWER)) if w] + [None]


def kept_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_log10(model, counts, tokens):
    """One token after the other, in doubles, over all classes and all words of a class."""
    lex, net = model.lexicon, model.network
    w = {n: getattr(net, n).astype(float) for n in net.NAMES}
    size, filled = len(w["offset"]), lex.head_classes * recurrent.CLASS_WORDS
    number = {x.as_py(): i for i, x in enumerate(lex.words)}
    found, mass = lex.classes()
    h, before, total = np.zeros(size), filled + len(mass) - 1, 0.0
    for token in tokens:
        x, a = w["gates"][before], h @ w["state"]
        z, r = (1 / (1 + np.exp(-(x[i * size : (i + 1) * size] + a[i * size : (i + 1) * size]))) for i in range(2))
        n = np.tanh(x[2 * size :] + r * (a[2 * size :] + w["offset"]))
        h = (1 - z) * n + z * h
        scores = h @ w["classes"] + w["class_bias"]
        classes = scores - np.log(np.exp(scores).sum())
        if token is None:
            c, inside = len(mass) - 1, 0.0
        elif token not in number:
            c, inside = len(mass) - 2, np.log((counts.get(token, 0) + 1) / lex.rest)
        elif number[token] < lex.heads:
            c, k = divmod(number[token], recurrent.CLASS_WORDS)
            own = slice(c * recurrent.CLASS_WORDS, (c + 1) * recurrent.CLASS_WORDS)
            scores = w["words"][own] @ h + w["word_bias"][own]
            inside = scores[k] - np.log(np.exp(scores).sum())
        else:
            c = found[number[token]]
            inside = np.log((counts[token] + 1) / mass[c])
        total += classes[c] + inside
        before = number[token] if token in number and number[token] < lex.heads else filled + c
    return total / np.log(10)


def test_scores_of_documents_equal_plain_counts_and_recurrence(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = documents.select("doc_id", "text").toPandas()
    texts = {d: words(t) for d, t in zip(held["doc_id"], held["text"], strict=True)}
    counts = Counter(w for d, t in texts.items() if not kept_out(d) for w in t)
    total, types = sum(counts.values()), len(counts)
    model = recurrent.fit(documents, limit=3000)  # so that words beyond the lexicon matter
    got = model.score(documents).toPandas().set_index("doc_id")
    assert len(got) == len(held) and len(model.lexicon.words) <= 3000 < types
    assert (got["train_tokens"] == total).all()
    for d, t in texts.items():
        row = got.loc[d]
        assert (row.held_out, row.n_tokens, row.n_known) == (kept_out(d), len(t), sum(w in counts for w in t))
        assert row.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + types + 1)) for w in t), rel=1e-9)
    for d in [*sorted(texts, key=lambda d: len(texts[d]))[:40], max(texts, key=lambda d: len(texts[d]))]:
        assert got.loc[d].score == pytest.approx(plain_log10(model, counts, texts[d]), rel=1e-4)
    unseen = got[got["held_out"]]
    assert unseen["score"].sum() > unseen["base_score"].sum() * 0.98


def test_probabilities_sum_to_one(spark):
    documents = spark.createDataFrame([(i, f"the {'cat' if i % 3 else 'dog'} sat on w{i % 40} w{i % 7} mat") for i in range(200)], "doc_id long, text string")
    model = recurrent.fit(documents, limit=20)
    lex = model.lexicon
    counts = {r["word"] and bytes(r["word"]): r["n"] for r in model.counts.collect()}
    start = ["the", "cat"]
    base = plain_log10(model, counts, [w.encode() for w in start])
    more = [plain_log10(model, counts, [*(w.encode() for w in start), w]) - base for w in [*counts, b"unseen"]]
    assert sum(10**x for x in more) == pytest.approx(1, abs=1e-5)
    assert lex.types == len(counts) and lex.tokens == sum(counts.values())


def test_gradients_equal_differences():
    lex = recurrent.Lexicon(pa.array([f"w{i}".encode() for i in range(150)], pa.large_binary()), np.arange(160, 10, -1), 5000, 200, 30, 90)
    random = np.random.default_rng(0)
    net = recurrent.Network.start(lex, 5)
    # Doubles, so that differences mean something.
    net = replace(net, **{n: getattr(net, n).astype(float) + random.normal(0, 0.1, getattr(net, n).shape) for n in net.NAMES})
    coder = recurrent.Coder(lex)
    text = pa.array([" ".join(f"w{random.integers(200)}" for _ in range(n)) for n in (9, 3, 0, 6)])
    coded = coder.code(*recurrent.texts.utf8(text))
    (window,) = recurrent.windows([coded], 2, 64)
    h = random.normal(size=(2, 5))
    _, grads, loss = net.gradients(window, h)
    for name in net.NAMES:
        value = getattr(net, name)
        for at in zip(*(random.integers(s, size=12) for s in value.shape), strict=True):
            losses = []
            for d in (1e-6, -1e-6):
                moved = value.copy()
                moved[at] += d
                losses.append(replace(net, **{name: moved}).gradients(window, h)[2])
            assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-7)


@pytest.mark.parametrize("lanes", [1, 3, 8])
def test_lanes_read_every_document_once_and_in_order(lanes):
    random = np.random.default_rng(1)
    batches, begin = [], 0
    for n in (5, 1, 30):
        lengths = random.integers(1, 50, n)
        at = np.concatenate(([0], np.cumsum(lengths)))
        first = np.zeros(at[-1], bool)
        first[at[:-1]] = True
        ids = begin + np.arange(at[-1], dtype=np.int32)  # classes name the tokens here
        batches.append(recurrent.Coded(None, None, None, ids, ids, ids, first, at))
        begin += at[-1]
    read, state = [], [[] for _ in range(lanes)]
    for window in recurrent.windows(batches, lanes, 4):
        state = state if window.order is None else [state[i] for i in window.order]
        for inputs, first in zip(window.inputs, window.first, strict=True):
            for lane, (i, f) in enumerate(zip(inputs.tolist(), first.tolist(), strict=True)):
                if f and state[lane]:
                    read.append(state[lane])
                    state[lane] = []
                state[lane].append(i)
    read += [s for s in state if s]
    expected, base = [], 0
    for b in batches:
        expected += [list(range(base + x, base + y)) for x, y in zip(b.at, b.at[1:], strict=False)]
        base += b.at[-1]
    assert sorted(read) == sorted(expected)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(recurrent, "_keys", lambda words: np.full(len(words), 7, np.uint64))
    lex = recurrent.Lexicon(pa.array([b"a", b"bb", b"c"], pa.large_binary()), np.array([3, 2, 1]), 6, 4, 0, 1)
    assert recurrent.Coder(lex).numbers(pa.array([b"c", b"x", b"a", b"bb"], pa.large_binary())).tolist() == [2, -1, 0, 1]


def test_odd_rows(spark):
    odd = odd_rows(spark)
    model = recurrent.fit(odd)
    rows = model.score(odd).collect()
    assert len(rows) == odd.count()
    assert all(np.isfinite([r.score, r.base_score]).all() and r.held_out is not None for r in rows)
    assert sorted(r.n_tokens for r in rows)[:5] == [1, 1, 1, 1, 2]
    twice = [r.score for r in rows if r.doc_id == 3]
    assert len(twice) == 2 and twice[0] == pytest.approx(twice[1])
    assert model.score(no_rows(spark)).count() == 0
    nobody = recurrent.fit(no_rows(spark))
    assert {(r.score, r.base_score, r.train_tokens) for r in nobody.score(odd).collect()} == {(0.0, 0.0, 0)}


def test_query_gives_a_row_for_every_document(spark, sf_dir):
    got = queries.op11_recurrent(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
