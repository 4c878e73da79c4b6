"""The llm operators against brute force, round trips, held-out accuracy and edge cases."""

import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreworks.llm import licenses, minhash, mixing, neighbours, pieces, quality, samples, simhash, toxicity, urls, warc
from oreworks.llm.components import components

LONG = "word and more " * 30_000
TEXTS = [None, "", "   ", "one", "Tie tie tie tie", "Tie tie tie tie", "é日本 \U0001f600 x▁y", LONG, "a b c d e f g h i j k l"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, part int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    rows = [(i, t, "en", f"s{i % 3}" if i else None, 1, "x", 7, 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None,) * 8, (None, "one", None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels", "embeddings", "pages")}


def test_classifiers_on_held_out_documents(tables):
    for operator, label, least in ((quality, "quality", 0.9), (toxicity, "toxic", 0.9)):
        model = operator.fit(tables["documents"], tables["labels"])
        scored = operator.score(tables["documents"], model).where(samples.held_out(F.col("doc_id")))
        seen = scored.join(tables["labels"], "doc_id").select("predicted", label, "score").toPandas()
        assert (seen["predicted"] == seen[label]).mean() >= least
        assert seen["score"].between(0, 1).all()


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_on_odd_rows(spark, tables, odd, nothing, operator):
    model = operator.fit(tables["documents"], tables["labels"])
    assert operator.score(odd, model).where("score between 0 and 1 and predicted is not null").count() == odd.count()
    assert operator.score(nothing, model).count() == 0
    nobody = operator.fit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert operator.score(odd, nobody).count() == odd.count()


def test_toxicity_tolerates_inserted_signs():
    table = toxicity._symbol_table()
    data, at = pa.array(["i.d-i*o_t", "1d10t", "i d i o t", "no", "a b"]), None
    data, at = next(toxicity.texts.pieces(data))
    words, first = toxicity.words_of(data, at, table)
    assert np.diff(first).tolist() == [1, 1, 1, 1, 2]
    assert len({words[i].as_py() for i in range(3)}) == 1
    close = toxicity.Landmarks(toxicity._binary([(b"\x09\x04\x09\x0f\x14",)])).radial(toxicity._binary([(b"\x09\x04\x18\x09\x0f\x14",), (b"\x08\x0f\x15\x13\x05",)]))
    assert close[0, 0] > 2 * close[1, 0]


def test_toxicity_reads_letters_in_any_form():
    table = toxicity._symbol_table()
    spelled = ["idiot", "ＩＤＩＯＴ", "\U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d", "ⓘⓓⓘⓞⓣ", "іdіоt", "1d10t", "𝖎𝖉𝖎𝖔𝖙"]
    words, first = toxicity.words_of(*next(toxicity.texts.pieces(pa.array([*spelled, "été", "\U00020000\U00020001"]))), table)
    assert np.diff(first).tolist() == [1] * (len(spelled) + 2)
    assert len({words[i].as_py() for i in range(len(spelled))}) == 1
    assert words[len(spelled)].as_py() != words[0].as_py() and len(words[len(spelled) + 1].as_py()) == 2


def test_toxicity_asks_the_second_machine_for_every_spelling(spark):
    """The first machine gives up no witness and no spelling of one with a symbol inserted."""
    insults = ["idiot", "moron", "stupid", "worthless", "pathetic", "scum", "loser", "ass"]
    plain = "stone river morning table window garden paper yellow quiet letter bridge winter assess lesson".split()
    random = np.random.default_rng(3)
    rows = []
    for i in range(400):
        words = list(random.choice(plain, 8))
        if i % 4 == 0:
            words[3] = insults[i // 4 % len(insults)]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    documents = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(documents.drop("toxic"), documents.select("doc_id", "toxic", F.lit(1).alias("quality")))
    spelled = [w[:cut] + letter + w[cut:] for w in insults for cut in range(1, len(w)) for letter in "abcdefghijklmnopqrstuvwxyz"]
    words, _ = toxicity.words_of(*next(toxicity.texts.pieces(pa.array(insults + spelled))), toxicity._symbol_table())
    assert (model.first_margins(words) >= model.gate).all()


def test_discriminant_equals_the_normal_densities():
    random = np.random.default_rng(0)
    x = np.concatenate((random.normal(0, 1, (200, 3)), random.normal(1, 2, (300, 3))))
    model = quality.discriminant(x, np.repeat([0, 1], [200, 300]))
    covariance = [np.linalg.inv(i.T @ i) for i in model.inverse]
    density = [
        np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) / np.sqrt(np.linalg.det(c)) * p
        for m, c, p in zip(model.mean, covariance, (0.4, 0.6), strict=True)
    ]
    assert np.allclose(model.probabilities(x), density[1] / (density[0] + density[1]))


def test_neighbours_recall_ties_and_odd_vectors(spark, tables):
    found = neighbours.search(tables["embeddings"], F.col("vec_id") % 20 == 0).toPandas()
    held = tables["embeddings"].toPandas()
    x, ids = np.array(held["embedding"].tolist(), float), held["vec_id"].to_numpy()
    recall = []
    for query, got in found.groupby("query_id"):
        score = x @ x[ids == query][0]
        score[ids == query] = -np.inf
        recall.append(len(set(got["vec_id"]) & set(ids[np.lexsort((ids, -score))[:20]])) / 20)
    assert np.mean(recall) >= 0.9
    rows = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0])]
    few = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank")
    assert [tuple(r)[:4] for r in few.collect()] == [(0, 1, 2, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 2.0)]
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).count() == 0


def test_query_rows_of_one_id_are_queries_each(spark):
    """Against brute force, with ids that repeat among queries and candidates, over several shards."""
    random = np.random.default_rng(5)
    ids = np.concatenate((np.zeros(40, int), random.integers(1, 30, 260)))
    x = np.round(random.normal(size=(300, 8)), 3)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(6)
    for kept in (3, 20):
        got = neighbours.search(rows, F.col("vec_id") % 10 == 0, nearest=kept).toPandas()
        found = [list(zip(g["rank"], g["vec_id"], g["score"].round(9), strict=True)) for _, g in got.sort_values("rank").groupby("query_row")]
        expected = []
        for i, v in zip(ids, x, strict=True):
            if i % 10 == 0:
                score = [sum(a * b for a, b in zip(v, w, strict=True)) for w in x]
                order = sorted((k for k in range(300) if ids[k] != i), key=lambda k: (-score[k], ids[k]))[:kept]
                expected.append([(r + 1, ids[k], round(score[k], 9)) for r, k in enumerate(order)])
        assert all([r for r, _, _ in f] == list(range(1, kept + 1)) for f in found)
        # Rankings have no order: each is held against the one it shares most with.
        alike = [max(len(set(f) & set(e)) for e in expected) for f in found]
        assert len(found) == len(expected) and sum(alike) >= 0.9 * kept * len(expected)


def test_index_returns_every_code_within_the_radius():
    random = np.random.default_rng(3)
    x = random.normal(size=(500, 16))
    coder = neighbours.learn(x)
    index = neighbours.Index(np.arange(500), x, coder)
    for radius in (0, 3, 9, 20):
        for code in index.codes[:20]:
            brute = np.flatnonzero(np.bitwise_count(index.codes ^ code).sum(axis=1) <= radius)
            assert (index.within(code, radius) == brute).all()


def test_components_equal_union_find(spark):
    random = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 1), (4, 4)]
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in pairs:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == {v: find(v) for v in parent}


def test_redirects_carry_blocks_and_allow_precedes(spark, nothing):
    link = '<head><LINK href="{}" rel=canonical></head>'
    pages = [
        (1, "http://a.org/x#f", link.format("https://b.net/es/1")),  # alias of a blocked url
        (2, "http://c.org/", '<meta http-equiv="refresh" content="0; url=//A.org/x">'),  # two steps away
        (3, "http://d.org/q", link.format("http://a.org/x")),
        (4, "http://e.org/", link.format("/here")),
        (5, "HTTP://WWW.Example.com/en/9?q", link.format("http://example.com/en/9")),
        (6, "http://f.org/z", link.format("http://example.com/en/9")),  # its aliases are blocked and allowed
        (7, "http://example.com.evil.org/en/", None),
        (8, None, link.format("http://b.net/es/1")),
        (9, "no scheme", ""),
        (None, "http://sub.b.net/fr/?", None),
        (11, "http://b.net", "<link rel='stylesheet' href='x'>"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(frame).collect()}
    assert got == {
        1: ("a.org", "/x", None, "block"), 2: ("c.org", "/", None, "block"), 3: ("d.org", "/q", None, "block"),
        4: ("e.org", "/", None, "allow"), 5: ("www.example.com", "/en/9", "www.example.com/en/", "allow"),
        6: ("f.org", "/z", None, "allow"), 7: ("example.com.evil.org", "/en/", None, "allow"), 8: ("", "", None, "allow"),
        9: ("", "", None, "allow"), None: ("sub.b.net", "/fr/", "net/fr/", "block"), 11: ("b.net", "", None, "allow"),
    }
    assert urls.judge(frame.limit(0)).count() == 0
    given = spark.createDataFrame([("http://e.org/", "http://x.net/fr/")], "from_url string, to_url string")
    assert urls.judge(frame, redirects=given).where("page_id = 4").first()["verdict"] == "block"


def test_mix_meets_targets(spark, tables, odd, nothing):
    documents = tables["documents"]
    mixed = mixing.mix(documents).withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))
    seen = mixed.toPandas()
    assert (seen["taken"] <= 2 * seen["size"]).all() and len(seen) == documents.count()
    by = seen.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), parts=("part", lambda p: (p > 0).sum()))
    assert (by["target"] - by["taken"]).abs().max() <= 1 and by["parts"].max() <= 1
    # The targets, by filling and sharing anew.
    size, weight = by.sort_index()["size"].to_numpy(float), np.array([5.0, 2, 1])[np.arange(len(by)) % 3]
    target, capped = np.zeros(len(by)), np.zeros(len(by), bool)
    while True:
        target[~capped] = (1.5 * size.sum() - 2 * size[capped].sum()) * weight[~capped] / weight[~capped].sum()
        over = ~capped & (target > 2 * size)
        if not over.any():
            break
        target[over], capped = 2 * size[over], capped | over
    assert np.allclose(target, by.sort_index()["target"])
    again = mixing.mix(documents).toPandas()
    assert again.sort_values("doc_id")["copies"].tolist() == seen.sort_values("doc_id")["copies"].tolist()
    few = mixing.mix(odd)
    assert few.count() == odd.count() and few.where("size = 0 and copies + part > 0").count() == 0
    assert mixing.mix(nothing).count() == 0 and mixing.repeated(nothing).count() == 0
    assert mixing.repeated(odd).columns == odd.columns


def test_mix_deals_copies_of_an_id_to_different_rows(spark, monkeypatch):
    """A third of all rows share an id, in texts of two sizes; no row of the tree holds many of them."""
    ids = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10)
    documents = spark.range(30_000).select(
        ids.alias("doc_id"), F.when(F.col("id") % 2 == 0, "a b").otherwise("a b c").alias("text"), F.when(F.col("id") < 20_000, "a").otherwise("b").alias("source")
    )
    largest = []
    stage = mixing.scratch.stage

    def looked_at(df, path):
        staged = stage(df, path)
        if "mix-round" in path:
            largest.append(staged.agg(F.max(F.size("played.done"))).first()[0])
        return staged

    monkeypatch.setattr(mixing.scratch, "stage", looked_at)
    mixed = mixing.mix(documents)
    assert max(largest) < 4 * mixing.ROW
    columns = ["doc_id", "source", "size", "copies", "part"]
    seen = mixed.select(columns).toPandas().sort_values(columns).to_numpy().tolist()
    assert len(seen) == 30_000 and sum(r[0] == 7 for r in seen) == 10_000
    by = mixed.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size") + F.col("part")).alias("taken")).collect()
    assert all(abs(r["target"] - r["taken"]) <= 1 for r in by)
    # Where the rows were written plays no part.
    again = mixing.mix(documents.repartition(5, F.rand(1)))
    assert again.select(columns).toPandas().sort_values(columns).to_numpy().tolist() == seen


def test_mix_is_fair(spark):
    """Over many equal documents the share taken twice is what the fraction asks for."""
    documents = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    seen = mixing.mix(documents).groupBy("source", "copies").count().collect()
    assert {(r["source"], r["copies"]): r["count"] for r in seen} == {("a", 2): 2000, ("b", 1): 2000}


def test_license_templates():
    scanner = licenses.Scanner()

    def labels(text):
        data, at = next(licenses.texts.pieces(pa.array([text])))
        return scanner.scan(data, at)[0]

    assert labels("Released under the terms of the MIT License!")["labels"] == "mit,mit-notice"
    assert labels("released under the a mit license")["labels"] == "mit"  # a word too many
    assert labels("permission is hereby granted free of charge to any person obtaining a copy of this to deal in it without restriction")["labels"] == "mit-notice"
    assert labels("licensed under the gnu general public license either version 3")["labels"] == "gpl,gpl-3.0"
    assert labels("GNU-general public license gnu general public license") == {"n_words": 8, "n_base": 2, "first_word": 0, "last_word": 4, "base_labels": "gpl", "labels": "gpl", "score": 0.5}
    # Against all ways to fill a template with nested options and gaps.
    words = {w: i for i, w in enumerate("abcd")}
    automaton = licenses.compile_template("a [[b [[c]]]] {0,2} d", words)
    good = {"ad", "abd", "abcd", "axd", "axxd", "abxd", "abxxd", "abcxd", "abcxxd"}
    import itertools

    for n in range(1, 6):
        for word in map("".join, itertools.product("abcdx", repeat=n)):
            ids = np.array([words.get(c, -1) for c in word])
            fits = any(len(word) >= len(g) and all(h == "x" or h == c for h, c in zip(g, word)) for g in good)
            assert automaton.matches(ids, 0) == fits, word


GPL = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the"
    " Free Software Foundation; either version {1} of the License, or (at your option) any later version.\n\n"
)
GPL_REST = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
    " FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {0}General Public License for more details.\n\nYou should have received a copy of the GNU"
    " {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"),"
    " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
    " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe"
    " above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS"
    " PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
    " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
    " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1."
    " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in"
    " binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution.\n\n{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
    " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT"
    " NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY"
    " OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,"
    " EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
    " without specific prior written permission.\n\n"
)
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy"
    " of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed"
    " under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
    " specific language governing permissions and limitations under the License."
)


def test_license_notices_and_bodies():
    scanner = licenses.Scanner()

    def more(text):
        """The labels of templates."""
        row = scanner.scan(*next(licenses.texts.pieces(pa.array([text]))))[0]
        return set(filter(None, row["labels"].split(","))) - {"gpl", "apache", "cc-by", "mit"}

    for kind, version, label in (
        ("", "2", "gpl-2.0"), ("", "3", "gpl-3.0"), ("Lesser ", "2.1", "lgpl-2.1"), ("Library ", "2", "lgpl-2.0"),
        ("Lesser ", "3", "lgpl-3.0"), ("Affero ", "3", "agpl-3.0"),
    ):
        grant, rest = GPL.format(kind, version), GPL_REST.format(kind)
        assert more(grant) == {label}
        assert more(grant + rest) == {label, f"{label}-header"}
        assert more((grant + rest).replace("distributed in", "given in")) == {label}
    whole = {
        MIT: {"mit-notice", "mit-text"}, BSD.format(""): {"bsd-2-clause"}, BSD.format(NAMES): {"bsd-3-clause"}, APACHE: {"apache-2.0", "apache-2.0-header"},
        BSD.replace("1.", "*").replace("2.", "*").format(NAMES.replace("3.", "*")): {"bsd-3-clause"},
    }
    for text, wanted in whole.items():
        assert more(text) == wanted
        begun = text.rsplit(" ", 3)[0]
        assert more(begun) == wanted - {"mit-text", "bsd-2-clause", "bsd-3-clause", "apache-2.0-header"}
    for text, wanted in {
        "available under the GPLv3": "gpl-3.0", "licensed under GPL-2.0-or-later": "gpl-2.0", "distributed under version 2 of the GNU General Public License": "gpl-2.0",
        "licensed under CC BY-SA 3.0": "cc-by-sa-3.0", "licensed under CC BY 2.5": "cc-by-2.5", "licensed under CC BY 4.0": "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa-4.0",
        "https://creativecommons.org/licenses/by-nc-nd/4.0/": "cc-by-nc-nd-4.0", "licensed under CC0 1.0 Universal": "cc0-1.0",
        "licensed under CC BY-NC 4.0": "cc-by-nc-4.0", "licensed under the Apache License, Version 2.0": "apache-2.0",
        "licensed under the GNU General Public License, version 3": "gpl-3.0", "released under the MIT License": "mit-notice",
    }.items():
        assert more(text) == {wanted}, text
    for text in ("the gnu general public license, version 2, is incompatible", "licensed under the terms of this license", "under version 3 of the plan"):
        assert more(text) == set()


def test_licenses_on_odd_rows(odd, nothing):
    found = odd.select("doc_id", licenses.scan(F.col("text")).alias("f")).select("doc_id", "f.*")
    assert found.count() == odd.count() and found.where("text is null and n_words > 0" if "text" in found.columns else "n_words < 0").count() == 0
    assert found.where("doc_id = 7").first()["n_words"] == 90_000
    assert nothing.select(licenses.scan(F.col("text"))).count() == 0


def test_fingerprints_equal_brute_force(spark, tables, odd, nothing):
    documents = tables["documents"].limit(300)
    rows = documents.orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in minhash.fingerprints(documents).collect()}
    assert len(found) == len(rows)

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    off = []
    for i, r in enumerate(rows):
        text, after = r["text"], rows[(i + 1) % len(rows)]["text"]
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        got = found[r["doc_id"]]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        off.append(abs(got["near_edited"] - len(a & b) / len(a | b)))
    assert np.mean(off) < 0.05 and max(off) < 0.2
    assert minhash.fingerprints(odd).count() == odd.count() and minhash.fingerprints(nothing).count() == 0
    assert minhash.fingerprints(odd.limit(1)).count() == 1
    same = odd.select("text", minhash.fingerprint("text").alias("f")).groupBy("text").agg(F.countDistinct("f").alias("n"))
    assert same.where("n > 1").count() == 0


def test_near_pairs_by_bands(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(1, base), (2, base), (3, base + " tail"), (4, "other " + base), (5, " ".join(f"v{i}" for i in range(200))), (6, None), (7, "")]
    classes, pairs = minhash.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in classes.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(1, 3), (1, 4), (3, 4)}


def test_near_duplicates_are_the_components_of_all_near_pairs(spark, tables, odd, nothing):
    words = [f"w{i}" for i in range(60)]
    # A hot group: a chain of near copies, of which the ends are not alike, and texts that share only passages.
    chain = [" ".join([f"n{j}" for j in range(i)] + words[i:]) for i in range(0, 30, 2)]
    apart = [" ".join(words[:25] + [f"x{i}_{j}" for j in range(30)]) for i in range(20)]
    hot = spark.createDataFrame(list(enumerate([*chain, *apart, *chain[:3]])), "doc_id long, text string")
    for documents in (tables["documents"], hot, odd):
        classes, pairs = minhash.near_pairs(documents)
        root = {r["doc_id"]: r["class_id"] for r in classes.collect()}
        parent = {c: c for c in root.values()}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for r in pairs.collect():
            a, b = sorted((find(r["a"]), find(r["b"])))
            parent[b] = a
        found = [tuple(r) for r in minhash.near_duplicates(documents).collect()]
        assert len(found) == documents.where("doc_id is not null").count()
        assert all(c == find(root[d]) for d, c in found)
    chained = {r["component_id"] for r in minhash.near_duplicates(hot).where(F.col("doc_id") < len(chain)).collect()}
    assert chained == {0}
    assert minhash.near_duplicates(nothing).collect() == []


def test_near_pairs_equal_brute_force(tables):
    classes, pairs = minhash.near_pairs(tables["documents"])
    chosen = {r["class_id"] for r in classes.collect()}
    sets = {}
    for r in tables["documents"].where(F.col("doc_id").isin(list(chosen))).collect():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]).encode().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    some = [(i, s) for i, s in sorted(sets.items(), key=lambda x: len(x[1])) if s]
    wanted = set()
    for at, (i, s) in enumerate(some):
        for j, o in some[at + 1 :]:
            if 0.8 * len(o) > len(s):
                break
            if len(s & o) >= 0.8 * len(s | o):
                wanted.add((min(i, j), max(i, j)))
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    assert found == wanted


def _simhash(text):
    import xxhash

    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(tables, odd, nothing):
    for documents in (tables["documents"], odd):
        rows = documents.select("doc_id", "text").collect()
        marks = [_simhash(r["text"]) for r in rows]
        parent = list(range(len(rows)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        value = np.array(marks, np.uint64)
        for i in range(len(rows)):
            for j in np.flatnonzero(np.bitwise_count(value[i + 1 :] ^ value[i]) <= 3) + i + 1:
                parent[find(int(j))] = find(i)
        groups = {}
        for i, r in enumerate(rows):
            if r["doc_id"] is not None:
                groups[find(i)] = min(groups.get(find(i), r["doc_id"]), r["doc_id"])
        expected = sorted((str(r["doc_id"]), f"{m:016x}", groups.get(find(i))) for i, (r, m) in enumerate(zip(rows, marks, strict=True)))
        got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents).collect())
        assert got == expected
        kept = simhash.keep_one(documents)
        assert kept.count() == len({find(i) for i in range(len(rows))}) and kept.columns == documents.columns
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & (1 << 64) - 1 for m in simhash.masks()]
    assert len(masks) == 15
    random = np.random.default_rng(2)
    for _ in range(3000):
        flipped = sum(1 << int(b) for b in random.choice(64, 3, replace=False))
        assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("n", [2, 50, 3000])
def test_tree_connects_what_pairs_connect(n):
    random = np.random.default_rng(n)
    rows = np.unique(np.bitwise_xor.accumulate(np.uint64(1) << random.integers(0, 64, n, dtype=np.uint64)))
    a, b = simhash.tree(rows)
    parent = {int(v): int(v) for v in rows}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert (x ^ y).bit_count() <= 3
        parent[find(x)] = find(y)
    for v in rows:
        near = rows[np.bitwise_count(rows ^ v) <= 3]
        assert len({find(int(w)) for w in near}) == 1


@pytest.fixture(scope="module")
def model():
    if not Path(pieces.default_model()).exists():
        pytest.skip("no public model file")
    return pieces.Pieces.read(pieces.default_model())


def _best(model, text):
    signs = pieces.MARK + text.replace(" ", pieces.MARK)
    ids = {t: i for i, (t, n) in enumerate(zip(model.text, model.normal, strict=True)) if n}
    best = [(0.0, [])]
    for end in range(1, len(signs) + 1):
        top = None
        for k in range(min(model.longest, end), 0, -1):
            part = signs[end - k : end]
            if part in ids:
                step = (best[end - k][0] + model.score[ids[part]], best[end - k][1] + [ids[part]])
            elif k == 1:
                step = (best[end - 1][0] + model.unknown_score, best[end - 1][1] + [int(model.byte_ids[b]) for b in part.encode()])
            else:
                continue
            if top is None or step[0] > top[0]:
                top = step
        best.append(top)
    return best[-1][1] if text else []


def test_pieces_equal_plain_viterbi_and_come_back(model, tables):
    some = sorted((r["text"] for r in tables["documents"].collect()), key=len)[:120] + ["", " ", "  a  b ", "é日本 \U0001f600\x00", "x" * 300, "a\tb\n"]
    coded = model.encode(pa.array(some))
    assert coded.to_pylist() == [_best(model, t) for t in some]
    assert model.decode(coded).to_pylist() == some


def test_pieces_of_odd_rows(model, odd, nothing):
    coded = odd.select("text", pieces.encode(F.col("text")).alias("ids"))
    back = coded.select("text", pieces.decode(F.col("ids")).alias("back"))
    blank = F.regexp_replace(F.coalesce("text", F.lit("")), pieces.MARK, " ")
    assert back.where(F.col("back") == blank).count() == odd.count()
    assert nothing.select(pieces.encode(F.col("text"))).count() == 0


@pytest.mark.parametrize("split", [3, 97, 1 << 20])
def test_archives_come_back_from_any_split(spark, tmp_path, split):
    fake = warc.record(99, "http://x/", b"inner", 5, warc.digest(b"inner"), None).decode()
    rows = [(1, "u", "ab"), (2, "u\r\nWARC-Type: x", "ab"), (3, None, None), (4, "x", ""), (None, "z", "ab"), (None, "z", "q"), (1, "u", "ab"), (8, "l", LONG), (9, "f", fake)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(3)
    files = warc.write(pages, str(tmp_path / "w"), file_bytes=400)
    got = warc.read(files, split)
    assert got.count() == len(rows) and got.where("not intact").count() == 0
    by_id = {(r["page_id"], r["payload_digest"]): r for r in got.collect()}
    assert by_id[2, warc.digest(b"ab")]["refers_to"] == 1 and by_id[4, warc.digest(b"")]["refers_to"] == 3
    assert by_id[8, warc.digest(LONG.encode())]["payload_bytes"] == len(LONG)
    assert bytes(by_id[9, warc.digest(fake.encode())]["payload"]).decode() == fake
    assert warc.read(warc.write(pages.limit(0), str(tmp_path / "e"))).count() == 0
    assert warc.read(warc.write(pages, str(tmp_path / "n"), least_bytes=10)).where("record_type = 'revisit'").count() == 0


def test_stored_member_inside_a_record_is_no_record():
    import gzip
    import zlib

    inner = gzip.compress(warc.record(99, "u", b"x", 1, warc.digest(b"x"), None))

    def stored(data):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()

    whole = b"".join(stored(warc.record(i, "u", inner, len(inner), warc.digest(inner), None)) for i in range(3))
    found = []
    for start in range(0, len(whole), 5):
        found += warc.Members(pa.BufferReader(whole), len(whole)).starting_in(start, min(start + 5, len(whole)))
    assert [warc.parsed(f)["page_id"] for f in found] == [0, 1, 2]


def test_pipeline_stages(spark, sf_dir, tables):
    import corpus_pipeline

    ids = {r["doc_id"] for r in tables["documents"].collect()}
    out = corpus_pipeline.run(spark, sf_dir)
    seen = out.toPandas()
    assert set(seen["doc_id"]) <= ids and seen["restored"].all()
    labels = tables["labels"].toPandas().set_index("doc_id")
    kept = labels.loc[labels.index.isin(seen["doc_id"])]
    assert (kept["toxic"] == 1).mean() < 0.1 and (kept["quality"] == 0).mean() < 0.05
    assert seen.groupby("doc_id").size().max() <= 2


def test_pipeline_stages_on_nothing(spark, sf_dir, nothing):
    import corpus_pipeline

    docs = nothing.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0, name
