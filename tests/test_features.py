import re
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import entry_queries
from lexigrade import session
from lexigrade.functions import tokens
from lexigrade.functions.text import ws_tokens, word_tokens
from lexigrade.operators import labels, select, sequences, vectorize
from lexigrade.plans.features import FeatureParams, encode_level, fit_feature_space, fit_vectors, preprocess
from lexigrade.session import write_stage
from lexigrade.sources import corpus

TRIO = [(0, "Νόμος νόμος ΟΔΟΣ"), (1, "οδος b_1 x"), (2, "x x y")]
ODD = [(10, None), (11, ""), (12, "?! ..."), (13, "unknown words only")]


def trio(spark, extra=()):
    rows = [(i, t, "train", "a") for i, t in TRIO] + [(i, t, "test", "a") for i, t in extra]
    return spark.createDataFrame(rows, "doc_id long, text string, split string, label string")


def test_word_tokens_golden(spark):
    text = "Éa_b ΆΣ ΟΔΟΣ x́y ١٢ ²"
    got = spark.createDataFrame([(text,)], "text string").select(word_tokens(F.col("text"))).first()[0]
    assert got == ["éa_b", "άς", "οδος", "x", "y", "١٢", "²"]
    assert got == re.findall(r"(?u)\b\w+\b", text.lower())


def test_whitespace_tokens_cut_on_every_unicode_space(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    assert len(spaces) == 29
    text = "".join(f"W{i}{s}" for i, s in enumerate(spaces)) + " ​ end·"
    got = spark.createDataFrame([(text,), (None,), (" ",)], "text string").select(ws_tokens(F.col("text"))).collect()
    assert [r[0] for r in got] == [text.lower().split(), [], []]


def test_tokens_of_the_corpus_equal_python(spark):
    docs = entry_queries.documents(spark, SF_SMALL)
    for r in docs.select("text", word_tokens(F.col("text")).alias("w"), ws_tokens(F.col("text")).alias("s")).collect():
        assert r["w"] == re.findall(r"(?u)\b\w+\b", r["text"].lower())
        assert r["s"] == r["text"].lower().split()


def test_vocabulary_and_tfidf_golden(spark):
    docs = trio(spark, ODD)
    space = fit_feature_space(docs, FeatureParams(10, 0, 0, "TFIDF"))
    got = {r["term"]: (r["tf"], r["df"], round(r["idf"], 6)) for r in space.terms.collect()}
    assert got == {"b_1": (1, 1, 1.693147), "x": (3, 2, 1.287682), "y": (1, 1, 1.693147), "νόμος": (2, 1, 1.693147), "οδος": (2, 2, 1.287682)}
    assert [r["term"] for r in space.terms.orderBy("term_id").collect()] == sorted(got)
    names = {r["term_id"]: r["term"] for r in space.terms.collect()}
    rows = {r["doc_id"]: {names[i]: round(v, 6) for i, v in zip(r["ids"], r["vals"])} for r in space.vectors(docs).collect()}
    assert rows[0] == {"νόμος": 0.934702, "οδος": 0.355432}
    assert rows[1] == {"b_1": 0.680919, "x": 0.517856, "οδος": 0.517856}
    assert rows[2] == {"x": 0.835592, "y": 0.549351}
    # Null, empty, punctuation-only and unknown texts stay as empty rows.
    assert all(rows[i] == {} for i, _ in ODD) and len(rows) == 7


def test_dropped_terms_are_not_renormalised(spark):
    docs = trio(spark)
    space = fit_feature_space(docs, FeatureParams(3, 1, 0, "tfidf"))
    ranked = space.terms.orderBy("rank").collect()
    assert len(ranked) == 4 and [r["kept"] for r in ranked] == [False, True, True, True]
    whole = vectorize.pack_vectors(docs, space.terms.drop("kept"), 4, "tfidf").collect()
    assert all(np.isclose(np.linalg.norm(r["vals"]), 1) for r in whole)
    kept = {r["term_id"] for r in ranked if r["kept"]}
    cut = {r["doc_id"]: (r["ids"], r["vals"]) for r in space.vectors(docs).collect()}
    for r in whole:
        pairs = [(i, v) for i, v in zip(r["ids"], r["vals"]) if i in kept]
        assert cut[r["doc_id"]] == ([i for i, _ in pairs], [v for _, v in pairs])


def test_stored_vectors_equal_fitted_ones(spark):
    docs = entry_queries.documents(spark, SF_SMALL)
    for rep in ("bow", "tfidf"):
        params = FeatureParams(300, 15, 10, rep)
        space, vectors = fit_vectors(docs, params, ("split",))
        again = fit_feature_space(docs, params)
        assert again.terms.select("term", "rank", "kept").exceptAll(space.terms.select("term", "rank", "kept")).count() == 0
        assert vectors.exceptAll(again.vectors(docs)).count() == 0 and vectors.count() == 200


def test_representations_share_one_count_of_the_texts(spark, monkeypatch, tmp_path):
    """Null and empty texts, a null id and a repeated one: the same ranks as from a count of their own."""
    rows = [(0, "Νόμος νόμος ΟΔΟΣ"), (1, "οδος b_1 x"), (2, "x x y"), (2, "x x y"), (3, None), (4, ""), (5, "?! ..."), (None, "x z"), (61, "z z z")]
    table = spark.createDataFrame([(i, t, "a", "s", 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    counted, fit_vocab = [], vectorize.fit_vocab
    monkeypatch.setattr(vectorize, "fit_vocab", lambda *a: counted.append(a) or fit_vocab(*a))
    spaces = {rep: entry_queries.space(spark, str(tmp_path), rep) for rep in vectorize.REPRESENTATIONS}
    assert len(counted) == 1
    listed = lambda space: sorted(tuple(r) for r in space.terms.collect())
    for rep, space in spaces.items():
        alone = fit_feature_space(entry_queries.documents(spark, str(tmp_path)), space.params)
        assert space.params.representation == rep and listed(space) == listed(alone)
        assert (space.n_terms, space.n_train) == (alone.n_terms, alone.n_train)
    assert {r[0] for r in listed(spaces["bow"])} == {"b_1", "x", "y", "νόμος", "οδος"}


def test_nothing_is_cut_without_skip_and_with_room(spark):
    space = fit_feature_space(trio(spark), FeatureParams(10, 0, 0, "bow"))
    assert space.terms.where("kept").count() == 5
    assert fit_feature_space(trio(spark), FeatureParams(2, 0, 0, "bow")).kept_terms().count() == 2


def test_representation_is_checked_before_any_job():
    with pytest.raises(ValueError):
        FeatureParams(representation="word2vec")
    assert FeatureParams(10_000, 30, 20).vocab_size == 9980
    assert FeatureParams(10_000, 30, 20).max_terms == 10_010
    assert FeatureParams(10_000, 30, 20).n_features == 998


def test_term_totals_equal_counts(spark):
    docs = entry_queries.documents(spark, SF_SMALL)
    counts = vectorize.term_counts(docs)
    by_count = counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    assert vectorize.corpus_terms(docs).exceptAll(by_count).count() == 0
    assert by_count.count() == vectorize.doc_freq(counts).count()


def test_tokens_stay_in_their_rows(spark, monkeypatch):
    """Vectors, sequences and counts without an exchange; the join form for large vocabularies gives the same."""
    docs = trio(spark, ODD)
    fitted = fit_feature_space(docs, FeatureParams(3, 1, 0, "tfidf"))
    made = {
        "packed": lambda: vectorize.pack_vectors(docs, fitted.terms, 4, "tfidf", ("split",)),
        "counted": lambda: vectorize.pack_vectors(docs, fitted.terms, 4, "bow"),
        "sequences": lambda: sequences.encode_sequences(docs, fitted.terms, 4, ("split",)),
    }
    got = {name: make() for name, make in made.items()}
    for df in (*got.values(), vectorize.term_counts(docs)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("lexigrade.session.BROADCAST_ROWS", 3)
    for name, make in made.items():
        assert make().orderBy("doc_id").collect() == got[name].orderBy("doc_id").collect(), name


def test_token_blocks_are_bounded(monkeypatch):
    lists = pa.array([["b", "a", "b"], [], None, ["c"], ["d", "d"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), lists], ["doc_id", "tokens"])
    want = [(0, ["a", "b"], [1, 2]), (1, [], []), (2, [], []), (3, ["c"], [1]), (4, ["d"], [2])]
    for cells in (1, 2, 4, 100):
        monkeypatch.setattr(tokens, "BLOCK_CELLS", cells)
        parts = list(tokens.count_terms([batch, batch.slice(0, 0)]))
        assert [tuple(r.values()) for part in parts for r in part.to_pylist()] == want


def test_counting_holds_no_more_for_a_larger_batch():
    """What counting and looking up hold beside a batch follows from the block, not from the rows of the batch."""
    terms = pa.array([str(i) for i in range(500)])

    def peak(n_rows: int) -> int:
        batch = pa.RecordBatch.from_arrays([pa.array(range(n_rows)), pa.array([[str(i % 500) for i in range(r, r + 300)] for r in range(n_rows)])], ["doc_id", "tokens"])
        tracemalloc.start()
        for _ in tokens.count_terms([batch]):
            pass
        for _, rows, words in tokens.token_blocks([batch]):
            at = tokens.find_terms(words, terms)
            tokens.count_pairs(rows[at >= 0], at[at >= 0], len(terms))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(4000) < 1.2 * peak(1000)


# -- labels -----------------------------------------------------------------------------------------


def test_unseen_labels(spark):
    rows = [(0, "train", "b"), (1, "train", "a"), (2, "train", "b"), (3, "train", "c"), (4, "test", "a"), (5, "test", "z"), (6, "validation", "c"), (7, "test", None)]
    docs = spark.createDataFrame(rows, "doc_id long, split string, mark string")
    coded, index, n = encode_level(docs, "mark")
    assert {r["label"]: (r["y"], r["n_class"]) for r in index.collect()} == {"b": (0, 2), "a": (1, 1), "c": (2, 1)} and n == 3
    assert {r["doc_id"]: r["y"] for r in coded.collect()} == {0: 0, 1: 1, 2: 0, 3: 2, 4: 1, 6: 2}
    held = labels.encode_heldout(docs.where("split <> 'train'").withColumnRenamed("mark", "label"), index, n)
    assert sorted(r["y"] for r in held.collect()) == [-1, -1, 1, 2]
    assert [r["y"] for r in labels.distinct_classes(coded).collect()] == [0, 1, 2]


@pytest.mark.parametrize("k", [1, 37, 400, 100_000])
def test_large_vocabularies_are_cut_in_ranges(spark, monkeypatch, k):
    """The same terms and ids, ties at the cut included, with no task that orders all of them."""
    train = entry_queries.documents(spark, SF_SMALL).where("split = 'train'").limit(60)
    want = {(r["term"], r["tf"], r["df"], r["term_id"]) for r in vectorize.fit_vocab(train, k).collect()}
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    large = vectorize.fit_vocab(train, k)
    assert {(r["term"], r["tf"], r["df"], r["term_id"]) for r in large.collect()} == want
    assert "TakeOrdered" not in large._jdf.queryExecution().executedPlan().toString()
    if k == 1:
        assert vectorize.fit_vocab(train.limit(0), 5).count() == 0


# -- selection --------------------------------------------------------------------------------------


def packed(spark, x, y):
    rows = [(i, int(y[i]), [int(f) for f in np.flatnonzero(x[i])], [float(v) for v in x[i][x[i] != 0]]) for i in range(len(x))]
    return spark.createDataFrame(rows, "doc_id long, y int, ids array<int>, vals array<double>")


def information(spark, x, y):
    train = packed(spark, x, y)
    totals = select.class_totals(train)
    cells = select.contingency(train)
    mi = select.mutual_information(cells, totals, len(set(y)), len(y))
    return train, cells, {r["y"]: r["n_class"] for r in totals.collect()}, {r["term_id"]: r["mi"] for r in mi.collect()}


def test_mutual_information_golden(spark):
    x = np.array([[0, 0], [0, 1], [1, 0], [2, 1], [1, 0], [0, 0]], dtype=float)
    *_, mi = information(spark, x, [0, 0, 1, 1, 1, 0])
    assert np.isclose(mi[0], np.log(2)) and np.isclose(mi[1], 0)


def test_mutual_information_and_cells_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x, y = rng.poisson(0.5, (60, 8)).astype(float), rng.integers(0, 4, 60)
    x[:, 7] = y + 1.0  # the label itself
    x[5] = 0
    _, cells, totals, mi = information(spark, x, y)
    entropy = brute.mutual_information(y, y)
    for f in range(8):
        assert np.isclose(mi[f], brute.mutual_information(x[:, f], y), atol=1e-12)
        assert 0 <= mi[f] <= entropy + 1e-9
    full = select.with_zero_cells(cells, totals)
    got = {(r["term_id"], r["value"], r["y"]): r["n"] for r in full.collect()}
    for f in range(8):
        for v in np.unique(x[:, f]):
            for c in range(4):
                n = int(np.sum((x[:, f] == v) & (y == c)))
                assert got.pop((f, v, c), 0) == n
    assert not got


def test_top_k(spark):
    scores = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9), (0, 0.1)], "term_id int, mi double")
    ranked = lambda k: [(r["term_id"], r["feature_id"]) for r in select.top_k_features(scores, k).orderBy("feature_id").collect()]
    assert ranked(2) == [(2, 0), (1, 1)]
    assert ranked(9) == [(2, 0), (1, 1), (3, 2), (0, 3)]
    with pytest.raises(ValueError):
        select.top_k_features(scores, 0)


def test_projection_by_constant_and_by_join_agree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.poisson(0.7, (25, 9)).astype(float)
    x[4] = 0
    rows = packed(spark, x, np.zeros(25))
    features = spark.createDataFrame([(7, 0), (2, 1), (5, 2)], "term_id int, feature_id int")
    results = []
    for limit in (select.LOOKUP_IDS, 0):
        monkeypatch.setattr(select, "LOOKUP_IDS", limit)
        out = select.project(rows, features, 9, 3, ("doc_id",)).collect()
        results.append({r["doc_id"]: (r["ids"], r["vals"]) for r in out})
    assert results[0] == results[1] and len(results[0]) == 25
    for i in range(25):
        dense = np.zeros(3)
        dense[results[0][i][0]] = results[0][i][1]
        assert np.array_equal(dense, x[i][[7, 2, 5]])


def test_results_do_not_depend_on_partitions(spark):
    docs = entry_queries.levelled(spark, SF_SMALL)
    seen = []
    for parts in (1, 7):
        moved = docs.repartition(parts)
        space = fit_feature_space(moved, FeatureParams(400, 10, 0, "tfidf"))
        vectors = write_stage(space.vectors(moved, ("split", "lang")), "vectors")
        data = preprocess(space, vectors, "lang")
        rows = data.train.orderBy("pos").collect()
        seen.append([(r["pos"], r["doc_id"], r["y"], r["ids"], r["vals"]) for r in rows])
    assert seen[0] == seen[1] and [r[0] for r in seen[0]] == list(range(120))


# -- sequences --------------------------------------------------------------------------------------


def test_padding_golden(spark):
    seqs = spark.createDataFrame([(0, [1, 2], 0), (1, [1, 2, 3, 4, 5], 1)], "doc_id long, seq array<long>, y int")
    for how, length, want in (("average", 3, [[1, 2, 0], [1, 2, 3]]), ("longest", 5, [[1, 2, 0, 0, 0], [1, 2, 3, 4, 5]])):
        padded, got = sequences.padded_dataset(seqs, how)
        assert got == length and [r["x"] for r in padded.orderBy("doc_id").collect()] == want


def test_sequences_keep_order_and_unknown_documents(spark):
    docs = trio(spark, ODD)
    vocab = vectorize.fit_vocab(docs.where("split = 'train'"), 10)
    ids = {r["term"]: r["term_id"] + 1 for r in vocab.collect()}
    got = {r["doc_id"]: r["seq"] for r in sequences.encode_sequences(docs, vocab, 5).collect()}
    assert got[0] == [ids["νόμος"]] * 2 + [ids["οδος"]] and got[1] == [ids["οδος"], ids["b_1"], ids["x"]]
    assert all(got[i] == [] for i, _ in ODD)


# -- sources ----------------------------------------------------------------------------------------


def test_positions_are_dense_in_key_order(spark, monkeypatch):
    monkeypatch.setattr(corpus, "POSITION_BUCKET_ROWS", 13)
    keys = np.random.default_rng(3).permutation(10_000)[:500]
    rows = spark.createDataFrame([(int(k),) for k in keys], "doc_id long").repartition(5)
    placed = corpus.with_positions(rows, 500)
    assert [r["doc_id"] for r in placed.orderBy("pos").collect()] == sorted(int(k) for k in keys)
    assert sorted(r["pos"] for r in placed.collect()) == list(range(500))
    assert corpus.with_positions(rows.limit(1), 1).first()["pos"] == 0


def test_levels_round_trip_and_prune(spark, tmp_path):
    docs = entry_queries.documents(spark, SF_SMALL).withColumn("label", F.col("lang"))
    corpus.write_level(docs, str(tmp_path), "lang")
    back = corpus.read_level(spark, str(tmp_path), "lang")
    assert back.exceptAll(docs.select(back.columns)).count() == 0 and back.count() == docs.count()
    plan = back.where("split = 'train'").select("label")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "ReadSchema: struct<label:string>" in plan
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, {"dev": str(tmp_path)})


def test_first_of_equal_texts(spark):
    docs = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus.distinct_texts(docs).collect()) == [1, 2]
