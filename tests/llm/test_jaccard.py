"""Near-duplicate components against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF0001

import tripaudit.llm.jaccard as J
from tripaudit.llm.components import connected_components
from tripaudit.llm.jaccard import jaccard_components, one_per_component, op9_grouped_prefix_join


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=75):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(str((d, len(s), least[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def result(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def corpus(seed, n=160):
    """Texts in families of graded likeness, with a passage that a third of them share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        else:
            words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 5, 20, 60, 90]))]
            if rng.random() < 0.35:
                words += passage
        rows.append((i * 7 % 1009, " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "rare"), [(1, False), (2, True), (3, True)])
def test_components_match_all_pairs(spark, monkeypatch, seed, rare):
    if rare:  # frequent shingles and wide ones already in a small corpus
        monkeypatch.setattr(J, "LOCAL", 2)
        monkeypatch.setattr(J, "FREQUENT", 6)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(jaccard_components(docs, rows_per_bucket=200)) == brute(rows)


def test_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(20_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "One two"), (9, "one TWO"), (9, "one two three"), (None, "one two"),
            (None, None), (3, "A b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (30, long), (31, long + " z"),
            (40, "İ a b c d"), (41, "i a b c d")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, a string")
    assert result(jaccard_components(docs)) == brute(rows)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_bucket_join_is_all_pairs_of_fitting_sizes(monkeypatch):
    monkeypatch.setattr(J, "JOINED", 4)
    rng = random.Random(5)
    block = np.zeros(60, J.ROW)
    for k in range(60):
        g = rng.randrange(12)
        block[k] = (rng.randrange(9), g, 10 + g, 0, 3, False)
    block["often"] = block["s"] == 8
    want, wide = set(), set()
    for s in range(9):
        groups = sorted({int(r["g"]) for r in block if r["s"] == s})
        if s == 8 or len(groups) > 4:
            wide |= {(s, g) for g in groups}
        else:
            want |= {(s, a, b) for a in groups for b in groups if a < b and 100 * (10 + a) >= 75 * (10 + b)}
    got, rows = set(), set()
    for kind, a, b in J.join_bucket(block, 75):
        if kind == 2:
            rows |= {(int(x["s"]), int(x["g"])) for x in a}
        else:
            got |= {(int(x["s"]), int(x["g"]), int(y["g"])) for x, y in zip(a, b)}
    assert got == want and rows == wide


def test_shingles_of_texts_hashed_together(monkeypatch):
    texts = [None, "", " \t", "a", "A b", "a\x0bb\tc d\r\ne", "é a b c d e", "x", "w " * 3000 + "z", "y" * 5000 + " a b c d e"]
    together = [J.distinct(h) for h in J.shingles(texts)]
    assert [len(h) for h in together] == [len(shingle_set(t)) for t in texts]
    for t, h in zip(texts, together):
        assert (J.distinct(J.shingles([t])[0]) == h).all()
    monkeypatch.setattr(J, "SEGMENT", 64)  # words and texts longer than a segment
    assert all((J.distinct(h) == w).all() for h, w in zip(J.shingles(texts), together))


def test_prefix_sizes():
    assert [J.prefix_size(n, 75) for n in (1, 2, 3, 4, 8, 100)] == [1, 1, 1, 2, 3, 26]


def test_connected_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (5, 5)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_one_document_of_each_component_stays(spark):
    rows = [(4, "a b c d e f g"), (2, "a b c d e f g"), (9, "other words"), (8, None), (None, "x y")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id long")
    out = one_per_component(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "8", "9", "None"]


def test_query_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert result(op9_grouped_prefix_join(spark, SF0001)) == brute(rows)


def test_no_text_is_lost_under_repeated_or_null_ids(spark):
    a, b, c = ("one two three four five six seven " + x for x in ("alpha", "beta gamma delta eps zeta eta", "omega psi chi"))
    rows = [(1, a, "x"), (2, a, "y"), (2, b, "z"), (3, b, "w"), (None, c, "n1"), (None, c, "n2"), (None, a, "n3"),
            (9, c + " c d e f g h i", "p"), (9, c + " c d e f g h i", "q"), (5, "", "e1"), (5, "", "e2"), (6, None, "e3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = one_per_component(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (None, c), (9, c + " c d e f g h i"), (5, ""), (5, ""), (6, None)], key=str)
    assert one_per_component(docs.limit(0)).count() == 0


def test_a_large_group_of_equal_rows_leaves_one(spark):
    same = "the same words again and again in every row of it"
    rows = [(7, same)] * 500 + [(i, same) for i in range(100, 200)] + [(8, "another text of six words here")]
    out = one_per_component(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(7, same), (8, "another text of six words here")]


def test_rows_cross_to_python_in_small_batches(spark, monkeypatch):
    from tripaudit.llm.tables import ARROW_CONF, ARROW_ROWS

    seen, own, scan = [], spark.conf.get(ARROW_CONF), J.frequent_shingles

    def noting(docs):
        sizes = spark.range(0, 5 * ARROW_ROWS, 1, 1).mapInArrow(
            lambda batches: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in batches), "n bigint")
        seen.extend(r.n for r in sizes.collect())
        return scan(docs)

    monkeypatch.setattr(J, "frequent_shingles", noting)
    rows = corpus(4, 20)
    assert result(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert sum(seen) == 5 * ARROW_ROWS and max(seen) == ARROW_ROWS
    assert spark.conf.get(ARROW_CONF) == own


def test_pairs_of_one_set_are_verified_in_parts(spark, monkeypatch):
    """A set that is the neighbour of many is copied, so that its pairs spread over tasks."""
    monkeypatch.setattr(J, "MET", 10)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base, f"x{i}"] if i % 2 else [f"y{i}_{k}" for k in range(40)])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = [J.number(J.distinct(h).tobytes()) for h in J.shingles([t for _, t in rows])]
    whole = J.SetTable(docs, spark.createDataFrame(list(zip(range(120), hashes)), "rep long, a long"))
    pairs = spark.createDataFrame([(hashes[i], hashes[1]) for i in range(120) if i != 1], "a long, b long")
    pairs = J.written(pairs, "test-pairs")
    checked = {(r.a, r.b): r.linked for r in whole.verify(pairs, 75).collect()}
    assert checked == {(hashes[i], hashes[1]): bool(i % 2) for i in range(120) if i != 1}
    met = (whole.joined(pairs, J.F.length("members")).select("right").withColumn("at", J.F.spark_partition_id())
           .groupBy("at").count().collect())
    assert len(met) > 2 and max(r["count"] for r in met) < 100


def test_shuffle_files_go_when_a_table_is_written(spark):
    def shuffled():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    before = shuffled()
    out = J.written(spark.range(1000).groupBy((J.F.col("id") % 7).alias("k")).count(), "test-shuffled")
    assert out.count() == 7
    kept = spark.range(1000).groupBy((J.F.col("id") % 7).alias("k")).count()
    J.written(kept, "test-shuffled")
    assert J.written(kept, "test-shuffled").count() == 7  # the same query once more
    assert shuffled() <= before + 2  # those of the two counts


def near_copies(seed, n, most):
    """Copies of one text with up to ``most`` of its words replaced, dropped or doubled."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(70)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(most)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[f"x{rng.randrange(60)}"], [], [words[at]] * 2, [f"y{i}"]])
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_sets_told_apart_by_their_pivots_match_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(J, "LOCAL", 2)
    monkeypatch.setattr(J, "FREQUENT", 6)
    monkeypatch.setattr(J, "STRAY", 0)
    tables, write = [], J.written
    monkeypatch.setattr(J, "written", lambda df, name: tables.append(name) or write(df, name))
    rows = near_copies(seed, 90, 14) + [(i + 1000, t) for i, t in corpus(seed, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(jaccard_components(docs, rows_per_bucket=200)) == brute(rows)
    assert "differences" in tables


def test_thinly_spread_shingles_count_as_frequent(spark):
    """A shingle met twice in every chunk is as frequent as one met often in one of them."""
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([*passage, *(f"w{i}_{k}" for k in range(10))]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(20)
    inside = J.distinct(J.shingles([" ".join(passage)])[0])
    got = J.frequent_shingles(docs)
    assert set(got.tolist()) == set(inside[inside < J.COUNTED].tolist())


@pytest.mark.parametrize("seed", [3, 4])
def test_sets_around_a_middle_that_none_of_them_is(spark, monkeypatch, seed):
    """Copies with two to six words replaced each: near ones link without looking at their pairs."""
    monkeypatch.setattr(J, "LOCAL", 2)
    monkeypatch.setattr(J, "FREQUENT", 6)
    tables, write = {}, J.written

    def noting(df, name):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(J, "written", noting)
    rng, rows = random.Random(seed), []
    for i in range(150):
        words = [f"b{k}" for k in range(90)]
        for at in rng.sample(range(90), rng.choice([2, 3, 4, 5, 6])):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(jaccard_components(docs, rows_per_bucket=200)) == brute(rows)
    assert "middles" in tables and tables["last"].count() < 600  # of 11,175 pairs


def test_all_frequent_shingles_are_found_however_many(spark, monkeypatch):
    """More of them than the order once could put last."""
    monkeypatch.setattr(J, "FREQUENT", 2)
    text = " ".join(f"w{i}" for i in range(600_000))
    docs = spark.createDataFrame([(1, text + " x"), (2, text + " y")], "doc_id long, text string").repartition(2)
    inside = J.distinct(J.shingles([text])[0])
    inside = inside[inside < J.COUNTED]
    got = J.frequent_shingles(docs)
    assert len(inside) > 200_000 and set(got.tolist()) == set(inside.tolist())


def test_the_least_frequent_shingles_give_way(spark, monkeypatch):
    often, seldom = ([f"{c}{i}" for i in range(200)] for c in "ps")
    texts = [" ".join([*often, f"x{i}", *(seldom if i < 30 else [])]) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    inside = J.distinct(J.shingles([" ".join(often)])[0])
    inside = set(inside[inside < J.HALF].tolist())
    everything = set(J.frequent_shingles(docs).tolist())
    monkeypatch.setattr(J, "MOST_FREQUENT", len(inside) + 20)
    got = set(J.frequent_shingles(docs).tolist())
    assert inside < got < everything
    monkeypatch.setattr(J, "MOST_FREQUENT", len(everything))
    assert set(J.frequent_shingles(docs).tolist()) == everything


def test_many_pairs_are_verified_portion_by_portion(spark, monkeypatch):
    """What is sent at once does not grow with the pairs."""
    tables, write = [], J.written
    monkeypatch.setattr(J, "written", lambda df, name: tables.append((name, write(df, name))) or tables[-1][1])
    monkeypatch.setattr(J, "SENT", 1 << 13)
    monkeypatch.setattr(J, "SENT_PART", 1 << 20)
    monkeypatch.setattr(J, "LOCAL", 2)
    monkeypatch.setattr(J, "FREQUENT", 6)
    rows = corpus(7, 120) + [(i + 2000, t) for i, t in near_copies(7, 60, 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(jaccard_components(docs, rows_per_bucket=200)) == brute(rows)
    size = {r.a: 8 * r.n for name, t in tables if name == "sets" and "members" in t.columns for r in t.collect()}
    sent = [sum(size[r.a] for r in t.collect()) for name, t in tables if name == "verified"]
    assert len(sent) > 4 and max(sent) < 3 * J.SENT and sum(sent) > 4 * J.SENT
