"""What each stage of the pipeline keeps, against plain Python over the same rows."""

import re
from collections import Counter, defaultdict

import pytest
import xxhash
from odd import no_rows, odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from oreworks.llm import pieces, quality, toxicity

WHITE = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def ids(rows):
    return sorted(r.doc_id for r in rows.select("doc_id").collect())


@pytest.mark.parametrize(("stage", "operator", "kept"), [("toxicity", toxicity, lambda s: s < 0.5), ("quality", quality, lambda s: s >= 0.3)])
def test_filters_keep_what_the_scores_say(spark, sf_dir, documents, labels, stage, operator, kept):
    got = dict(corpus_pipeline.STAGES)[stage](spark, documents, sf_dir)
    scored = operator.score(documents, operator.fit(documents, labels)).select("doc_id", "score").collect()
    assert ids(got) == sorted(r.doc_id for r in scored if kept(r.score))
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert got.exceptAll(documents).count() == 0


def fingerprint(text):
    words = [w for w in WHITE.split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_near_duplicates_leave_the_first_of_each_component(spark, sf_dir, documents):
    held = documents.select("doc_id", "text").collect()
    prints = {r.doc_id: fingerprint(r.text) for r in held}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    by_print = defaultdict(list)
    for d, p in prints.items():
        by_print[p].append(d)
    different = list(by_print)
    links = [(p, q) for i, p in enumerate(different) for q in different[:i] if (p ^ q).bit_count() <= 3]
    for a, b in [(by_print[p][0], by_print[q][0]) for p, q in links] + [(x[0], y) for x in by_print.values() for y in x]:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(corpus_pipeline.STAGES)["dedup"](spark, documents, sf_dir)
    assert ids(got) == sorted({find(d) for d in prints})


def test_mixing_repeats_rows_towards_the_targets(spark, sf_dir, documents):
    got = dict(corpus_pipeline.STAGES)["mixing"](spark, documents, sf_dir)
    size = {r.doc_id: len([w for w in WHITE.split(r.text or "") if w]) for r in documents.select("doc_id", "text").collect()}
    source = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    total = Counter()
    for d, s in source.items():
        total[s] += size[d]
    target, weight = {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total, key=lambda s: (s is None, s)))}
    open_, left = set(total), 1.5 * sum(total.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * total[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 2 * total[s] for s in over})
        left -= sum(2 * total[s] for s in over)
        open_ -= over
    taken = Counter()
    copies = Counter(ids(got))
    for d, n in copies.items():
        taken[source[d]] += n * size[d]
        assert n <= 2
    largest = max(size.values())
    for s in total:
        assert abs(taken[s] - target[s]) <= 2 * largest, s


def test_tokens_are_those_of_the_coder(spark, sf_dir, documents):
    got = dict(corpus_pipeline.STAGES)["tokens"](spark, documents, sf_dir)
    plain = documents.select("doc_id", pieces.encode(F.col("text")).alias("tokens"))
    assert ids(got) == ids(documents)
    assert got.select("doc_id", "tokens").exceptAll(plain).count() == 0
    assert got.where("n_tokens <> size(tokens) OR NOT restored").count() == 0


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows_pass_every_stage(spark, sf_dir, stage):
    """Nulls in every column, empty and long texts, repeated rows, other columns: no stage invents rows or fails."""
    odd = odd_rows(spark)
    got = dict(corpus_pipeline.STAGES)[stage](spark, odd, sf_dir)
    rows = got.collect()
    texts = [r.text for r in odd.collect()]
    if stage == "tokens":
        assert len(rows) == odd.count()
    elif stage == "mixing":
        assert all(n <= 2 * texts.count(t) for t, n in Counter(r.text for r in rows).items())
    else:
        assert not Counter(r.text for r in rows) - Counter(texts)
    if stage == "dedup":
        assert len({r.text for r in rows}) == len(rows)
    assert dict(corpus_pipeline.STAGES)[stage](spark, no_rows(spark), sf_dir).count() == 0
