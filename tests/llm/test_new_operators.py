"""Whitening, decontamination and conversation repair: against dense linear algebra, plain search and SQL on awkward tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import conversations, decontaminate, whitening
from shelfline.llm.common import table
from tests.compare import difference
from tests.llm.test_operators import table_of

VECTORS = "vec_id long, embedding array<float>, n long, x string, ids array<long>, component int"


def pairs_of(matrix, k=8, **settings):
    return whitening.jacobi_davidson(lambda v: matrix @ v, len(matrix), k, **settings)


@pytest.mark.parametrize("values", [
    1 / np.arange(1, 301), np.linspace(1, 0.5, 200), np.r_[np.ones(4), 0.9 * np.ones(6), np.linspace(0.5, 0, 90)], np.r_[3.0, 2, 1, np.zeros(20)], np.ones(30), np.zeros(5), np.array([2.0])])
def test_eigenpairs_without_the_matrix(values):
    rnd = np.random.default_rng(1)
    q, _ = np.linalg.qr(rnd.standard_normal((len(values), len(values))))
    matrix = q @ np.diag(values) @ q.T
    found = pairs_of((matrix + matrix.T) / 2)
    k = min(8, len(values))
    want = np.sort(values)[::-1][:k]
    assert np.abs(found.values - want).max() <= 1e-13 * max(1, want[0])
    assert found.residuals.max() <= 1e-12 * max(1, want[0])
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-13


def test_a_full_space_starts_again():
    rnd = np.random.default_rng(2)
    q, _ = np.linalg.qr(rnd.standard_normal((400, 400)))
    values = np.linspace(1, 0.2, 400)
    found = pairs_of(q @ np.diag(values) @ q.T, most=40)
    assert np.abs(found.values - values[:8]).max() < 1e-13 and found.residuals.max() < 1e-12


def test_minres_solves_several_systems():
    rnd = np.random.default_rng(3)
    a = rnd.standard_normal((20, 20))
    b = np.column_stack([rnd.standard_normal((20, 2)), np.zeros(20)])
    x = whitening.minres(lambda v: (a + a.T) @ v, b, 60, 1e-14)
    assert np.abs((a + a.T) @ x - b).max() < 1e-10


def whitened_by_hand(vectors, k=8):
    """n, deviations, whitened rows, explained shares by dense linear algebra."""
    x = [[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x], y @ q / np.sqrt(e), e / np.trace(y.T @ y / n)


def compare_whitening(found, ids, vectors, k=8):
    n, deviations, want, share = whitened_by_hand(vectors, k)
    got = defaultdict(dict)
    for r in found:
        assert r.n == n and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        got[r.vec_id][r.component] = r
    assert len(found) == len(ids) * k
    signs = np.sign([got[ids[0]][j + 1].whitened * want[0][j] for j in range(k)])
    for i, d, row in zip(ids, deviations, want):
        assert all(abs(got[i][j + 1].whitened - signs[j] * row[j]) < 1e-7 for j in range(k))
        assert got[i][1].deviation == d


def test_whitening_query(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    compare_whitening(whitening.whitened(table(spark, sf, "embeddings")).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whitening_of_awkward_vectors(spark):
    rnd = random.Random(4)
    good = [[rnd.gauss(0, 1 + j) for j in range(5)] for _ in range(300)]
    good = [[float(np.float32(c)) for c in v] for v in good]
    rows = [(i, v, 1, "x", [1], 2) for i, v in enumerate(good)]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + [(i, v, 1, "x", [1], 2) for i, v in bad], VECTORS).repartition(4)
    # five dimensions have five components
    compare_whitening(whitening.whitened(df).collect(), list(range(300)), good, 5)
    # short vectors are filled with zeros, null and repeated ids are rows of their own
    short = [[1.0], [0.0, 2.0], [3.0, 1.0], [3.0, 1.0], []]
    found = whitening.whitened(spark.createDataFrame([(None if i < 2 else 7, v) for i, v in enumerate(short)], "vec_id long, embedding array<float>")).collect()
    assert len(found) == 10 and Counter(r.vec_id for r in found) == {None: 4, 7: 6}
    full = [v + [0.0] * (2 - len(v)) for v in short]
    assert sorted({r.deviation for r in found}) == sorted(set(whitened_by_hand(full, 2)[1]))


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        df = whitening.whitened(spark.createDataFrame(rows, schema))
        assert df.count() == 0 and [f.name for f in df.schema] == [c.split()[0] for c in whitening.RESULT.split(", ")]
    # one direction only; finite but huge components
    assert {r.component for r in whitening.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()} == {1}
    huge = whitening.whitened(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])], schema)).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and all(r.deviation is None for r in huge if r.vec_id < 3)


def test_deviation_is_exact():
    x = np.array([[2**40, -(2**41)], [7, 9], [2**40, 5]])
    sums = [int(c) for c in x.sum(axis=0)]
    want = [sum((3 * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert whitening.exact_deviation(x, 3, sums) == [w if w < 2**63 else None for w in want]
    small = np.array([[100000, 99000], [100500, 99001], [1, 2]])
    sums = [int(c) for c in small.sum(axis=0)]
    assert whitening.exact_deviation(small, 3, sums) == [sum((3 * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in small]


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def contaminated_by_hand(docs, items, window=10):
    out = []
    held = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            held[tuple(w[i:i + n])].add("" if item is None else str(item))
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in held}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in held:
                    hit |= set(range(i, i + n))
                    found |= held[tuple(w[i:i + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def awkward_benchmark():
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma7", "délta", "日本", "ÉTÉ", "x", "don't", "a_b"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, say(rnd.randrange(9, 30))) for i in range(12)] + [(12, "solo"), (13, "two Words"), (14, ""), (15, None), (None, say(14)), (3, say(11)), (3, say(11)), (100, "!!! ... ?")]
    items += [(20, items[0][1]), (0, items[0][1])]
    docs = [(i, t) for i, t in enumerate(["", None, " \n", "SOLO", "solo-solo, words two words", say(3000), "a" * 5000, "\x00 \x1c|{}"])]
    docs += [(50 + i, say(20) + ". " + (t or "").upper().replace(" ", ",\n") + "; " + say(8)) for i, (_, t) in enumerate(items)]
    docs += [(90, " ".join(t or "" for _, t in items) * 2), (None, items[1][1]), (None, None), (91, items[0][1][1:]), (91, items[0][1]), (91, items[0][1])]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"pack_words": 60}, {"window": 3}])
def test_decontamination_of_awkward_texts(spark, settings):
    docs, items = awkward_benchmark()
    df = spark.createDataFrame([(d, t, "e", 1, 2, [3]) for d, t in docs], "doc_id long, text string, item string, row long, n_words int, starts array<int>").repartition(3)
    benchmark = spark.createDataFrame([(i, t, "w", 5) for i, t in items], "item_id long, text string, words string, at int")
    got = Counter(tuple(r) for r in decontaminate.contamination(df, benchmark, **settings).collect())
    assert got == contaminated_by_hand(docs, items, settings.get("window", 10))


def test_decontamination_matches_sql(spark):
    docs, items = awkward_benchmark()
    con = table_of(documents=([("doc_id", pa.int64()), ("text", pa.string())], docs), benchmark=([("item_id", pa.int64()), ("text", pa.string())], items))
    df = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert difference(df, con, decontaminate.SQL) is None


def test_decontamination_of_empty_tables(spark):
    docs, items = awkward_benchmark()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    got = Counter(tuple(r) for r in decontaminate.contamination(d, b.limit(0)).collect())
    assert got == contaminated_by_hand(docs, [])


def test_long_items_and_slices_of_long_texts(spark, monkeypatch):
    rnd = random.Random(6)
    text = " ".join(f"w{rnd.randrange(50)}" for _ in range(5000))
    pieces = decontaminate.item_pieces(spark.createDataFrame([(1, text)], "item_id long, text string"), 10).collect()
    assert len(pieces) == 3
    whole = decontaminate.Benchmark([("1", text.split())], 10)
    cut = decontaminate.Benchmark([(r.item, r.words) for r in pieces], 10)
    assert len(whole.items) == len(cut.items)
    doc = ("x, " + text + " y.").encode()
    want = cut.scan(doc)
    assert want[:3] == (5002, [1], [5001])
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    assert cut.scan(doc) == want


def test_shifts_pass_over_most_words():
    """The search looks at a block for each shift: far fewer than there are words when no window is near."""
    rnd = random.Random(7)
    bench = decontaminate.Benchmark([(str(i), [f"q{rnd.randrange(500)}" for _ in range(30)]) for i in range(50)], 10)
    looked = []
    search = bench.tables[0]
    shift = search.shift

    class Counted(dict):
        def get(self, key, default):
            looked.append(key)
            return shift.get(key, default)

    search.shift = Counted()
    n, *_ = bench.scan(" ".join(f"q{rnd.randrange(500)}" for _ in range(20000)).encode())
    assert n == 20000 and len(looked) < n / 4


TURNS = "conv_id long, turn long, role string, text string, key string, pos long, blocks int"


def awkward_turns():
    rnd = random.Random(8)
    texts = ["Yes.", "no", "Why?", " ", "", None, "end. ", "tail  ", "Sure!\n", "long " * 3000 + ".", "\x00.", "\tx"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "agent", "União"]
    rows = [(c, t if rnd.random() > 0.1 else None, rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in rnd.sample(range(12), rnd.randrange(1, 10))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(40)] + [(101, 1, "user", "same.")] * 9 + [(102, None, None, None)] * 3
    rows += [(None, t, "user", "Hm.") for t in (1, 5, 9)] + [(None, None, "assistant", "x.")] + [(103, -(2**40), "user", "a."), (103, 2**40, "assistant", "b.")]
    return rows + rows[:5]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in awkward_turns()], TURNS).repartition(4)


@pytest.mark.parametrize("block_rows", [2048, 3, 1])
def test_repair_of_awkward_turns(turns, block_rows):
    con = table_of(conversations=([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())], awkward_turns()))
    assert difference(conversations.repaired(turns, block_rows), con, conversations.SQL) is None


def test_blocks_of_the_given_table(spark, sf):
    rows = table(spark, sf, "conversations")
    whole = Counter(tuple(r) for r in conversations.repaired(rows).collect())
    assert Counter(tuple(r) for r in conversations.repaired(rows, 2).collect()) == whole


def test_repair_of_nothing(turns):
    assert conversations.repaired(turns.limit(0)).count() == 0


def test_cheapest_edits_are_those_of_trying_all():
    rnd = random.Random(9)
    for _ in range(5000):
        rows = [(rnd.choice("ssuaua-"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randrange(10))]
        assert conversations.cheapest(rows) == conversations.plain_repair(rows)


def test_a_conversation_that_damage_drops_keeps_its_row(spark):
    import zlib
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (r,) = conversations.repaired(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")).collect()
    assert tuple(r) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
