"""The operators on training text: against SQL on the given tables, against brute force on awkward ones."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import bpe, exact_dedup, line_dedup, mixing, mtree, sharding, simhash, substring_dedup, toxicity, warc
from shelfline.llm.queries import ORACLE, QUERIES, VOCABULARY
from tests.compare import connect, difference

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, row long, fp long, pack long, term string, doc long, at int, target double"


def rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, shared lines and passages."""
    rnd = random.Random(3)
    words = ["alpha", "beta", "Gamma", "délta", "日本", "x1", "don't", "<|endoftext|>", "end."]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, line = say(60), "This Line is shared by very many documents"
    texts = ["", None, " \t\n", "one", "one", "ONE", "one  two", "one\ttwo", "\n\n", passage, passage + " tail", "head " + passage, say(20000), passage.upper(),
             f"a\n  {line}\nb", f"{line.lower()}\nc", f"{line}\n{line}", " nbsp  em", "a" * 5000, "\x00\x01 \x0b \x1c", say(40), say(41)]
    texts += [f"{say(30)}\n{line}\n{passage}" for _ in range(8)] + ["same text again"] * 12
    out = [(i if i != 7 else None, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"src{i % 3}", None) for i, t in enumerate(texts)]
    out += [out[9], out[9], out[14], (None, None, None, None, None), (3, "another text of document three", "en", "src1", 5)]
    return out


@pytest.fixture(scope="module")
def awkward(spark):
    full = [(*r, 1, 2, True, 4, 5, 6, "t", 7, 8, 0.5) for r in rows()]
    return spark.createDataFrame(full, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in rows()]


def table_of(**tables):
    con = duckdb.connect()
    for name, (schema, data) in tables.items():
        cols = list(zip(*data)) if data else [[] for _ in schema]
        con.register(name, pa.table({n: pa.array(c, t) for (n, t), c in zip(schema, cols)}))
    return con


@pytest.fixture(scope="module")
def sql():
    kinds = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
    return table_of(documents=(kinds, rows()))


def same(df, want):
    got = Counter(tuple(r) for r in df.collect())
    want = Counter(want)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, name):
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None


def test_exact_duplicates(spark, awkward, nothing, sql):
    assert difference(exact_dedup.exact_duplicates(awkward), sql, exact_dedup.SQL) is None
    # identifiers that clash are told apart by their texts
    for bits in (1, 4, 7):
        assert difference(exact_dedup.exact_duplicates(awkward, key_bits=bits), sql, exact_dedup.SQL) is None
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    once = exact_dedup.deduplicated(awkward)
    assert once.columns == awkward.columns
    norm = exact_dedup.normalised()
    assert once.count() == once.select(norm).distinct().count() == awkward.select(norm).distinct().count()


def test_chunks_cover_the_text_and_move_little(spark):
    rnd = random.Random(5)
    text = " ".join("".join(rnd.choice("aeioubcdfgrst") for _ in range(rnd.randint(1, 9))) for _ in range(4000))
    df = spark.createDataFrame([(text,), ("new words in front " + text,)], "norm string")
    a, b = (r[0] for r in df.select(F.regexp_extract_all("norm", F.lit(exact_dedup.CHUNK), F.lit(0))).collect())
    assert "".join(a) == text and len(a) > 10
    assert len(set(a) & set(b)) >= 0.9 * len(a)


def ring_by_hand(pairs, shards, virtual_nodes, cells):
    """The result row by row: a key goes to the next virtual node clockwise; what finds it full goes on clockwise, in two turns."""
    nodes = []
    for shard in range(shards):
        for copy in range(virtual_nodes):
            place = int(hashlib.md5(f"{shard}/{copy}".encode()).hexdigest()[:16], 16)
            nodes.append((place % cells, place, shard))
    nodes.sort()
    waiting = [[] for _ in nodes]
    for doc_id, text in pairs:
        data = (text or "").encode()
        key = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
        place = key - (1 << 64) if key >> 63 else key
        row = (doc_id, len(data) + 16, zlib.crc32(data))
        after = [i for i, node in enumerate(nodes) if node[0] >= place % cells]
        waiting[after[0] if after else 0].append(((place % cells, place, doc_id is not None, doc_id or 0, *row[1:]), row))
    room = [len(pairs) // shards + (s < len(pairs) % shards) for s in range(shards)]
    out, used = [], [0] * shards

    def offer(queue, shard):
        rest = []
        for item in queue:
            if used[shard] < room[shard]:
                out.append((*item[1], "rows", shard, used[shard], None))
                used[shard] += 1
            else:
                rest.append(item)
        return rest

    waiting = [offer(sorted(queue, key=lambda item: item[0]), nodes[i][2]) for i, queue in enumerate(waiting)]
    travelling = []
    for i in [*range(len(nodes)), *range(len(nodes))]:
        travelling, waiting[i] = travelling + waiting[i], []
        travelling = offer(travelling, nodes[i][2])
    assert not travelling
    return out


@pytest.mark.parametrize("shards,virtual_nodes,cells", [(40, 20, 512), (3, 5, 64), (1, 2, 16)])
def test_ring_matches_the_ring_by_hand(spark, awkward, pairs, shards, virtual_nodes, cells):
    same(sharding.ring_shards(awkward, shards, virtual_nodes=virtual_nodes, cells=cells), ring_by_hand(pairs, shards, virtual_nodes, cells))


def test_ring_query_matches_the_ring_by_hand(spark, sf):
    docs = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text")
    same(QUERIES["op3_ring_shards"](spark, sf), ring_by_hand([tuple(r) for r in docs.collect()], 40, 100, 65536))


@pytest.mark.parametrize("shards,slack", [(40, 0.0), (3, 0.0), (7, 0.25)])
def test_ring_shards(spark, awkward, shards, slack):
    got = sharding.ring_shards(awkward, shards, virtual_nodes=20, slack=slack, cells=512).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(got) == awkward.count() and set(by) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    n = [len(by[s]) for s in range(shards)]
    assert max(n) - min(n) <= 1 if not slack else max(n) <= -(-(1 + slack) * len(got) // shards)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16) for r in awkward.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.size) for r in got) == want


def test_ring_walk_is_that_of_single_keys():
    """Row by row: each key takes the next virtual node clockwise whose shard has room, own arcs before overflow."""
    nodes, rnd = sharding.ring(5, 8, 256), random.Random(1)
    cells = sorted(rnd.randrange(256) for _ in range(200))
    cap = sharding.capacities(200, 5, 0)
    got = sharding.walk(Counter(cells), nodes, cap)
    placed = Counter()
    for _, lo, hi, shard, slot in got:
        assert slot == placed[shard]
        placed[shard] += hi - lo
    assert [placed[s] for s in range(5)] == cap
    own, room = Counter(), list(cap)
    places = [c for c, _ in nodes]
    for c in cells:
        own[next((i for i, p in enumerate(places) if p >= c), 0)] += 1
    kept = Counter()
    for i, (_, shard) in enumerate(nodes):
        n = min(own[i], room[shard])
        room[shard] -= n
        kept[shard] += n
    # no shard holds less than its own arcs give it
    assert all(placed[s] >= kept[s] for s in range(5))


def test_one_more_shard_moves_a_part(spark, sf):
    docs = spark.read.parquet(sf + "/documents.parquet")
    a, b = ({r.doc_id: r.shard for r in sharding.ring_shards(docs, n, slack=0.2).collect()} for n in (10, 11))
    assert sum(a[d] != b[d] for d in a) < 0.35 * len(a)


def test_ring_of_nothing(nothing):
    assert sharding.ring_shards(nothing).count() == 0


def test_fair_mix(awkward, nothing, sql):
    assert difference(mixing.fair_mix(awkward), sql, mixing.SQL) is None
    assert mixing.fair_mix(nothing).count() == 0
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns


def test_mix_decides_row_by_row(spark):
    rnd = random.Random(9)
    ids = [None] * 60 + [1, 2, 3] * 40 + list(range(10, 110))
    data = [(d, "" if i % 11 == 0 else " ".join(["w"] * rnd.randint(1, 9)) + f" {i}", f"s{i % 3}") for i, d in enumerate(ids)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    want, got = Counter(), Counter()
    for r in mixing.fair_mix(df).collect():
        want[r.doc_id, r.size] += r.taken
    for r in mixing.mixed_documents(df).collect():
        got[r.doc_id, len(r.text.split())] += len(r.text.split())
    assert +want == got


def test_mix_is_near_its_targets(spark, sf):
    got = mixing.fair_mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    taken, size = Counter(), Counter()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.target, r.source_size] += r.taken
        size[r.target, r.source_size] = max(size[r.target, r.source_size], r.size)
    assert all(abs(taken[t] - t[0]) <= 2 * size[t] for t in taken)


def test_substrings(awkward, nothing, pairs):
    want = substring_dedup.brute_force(pairs)
    same(substring_dedup.passage_digest(awkward), want)
    same(substring_dedup.passage_digest(awkward, pack_words=50, range_words=300), want)
    assert sum(r[2] for r in want) > 100
    assert substring_dedup.passage_digest(nothing).count() == 0


def test_lines(awkward, nothing, pairs):
    want = line_dedup.brute_force(pairs)
    same(line_dedup.line_digest(awkward), want)
    # full filters let every line through to the exact count
    same(line_dedup.line_digest(awkward, bits=1 << 20, probes=1), want)
    same(line_dedup.line_digest(awkward, bits=1 << 22), want)
    assert any(r[2] for r in want)
    assert line_dedup.line_digest(nothing).count() == 0


def test_filters_grow_with_the_lines(spark, monkeypatch):
    assert [line_dedup.filter_bits(n, 8, 1 << 30) for n in (0, 1 << 17, (1 << 17) + 1, 10**8, 10**12)] == [1 << 20, 1 << 20, 1 << 21, 1 << 30, 1 << 30]
    widths, chosen, passed = [], line_dedup.filter_bits, []
    monkeypatch.setattr(line_dedup, "filter_bits", lambda *a: widths.append(chosen(*a)) or widths[-1])
    monkeypatch.setattr(line_dedup, "store", lambda df, name: (passed.append(df.count()) if name == "suspects" else None) or df)
    for n in (3000, 30_000):
        texts = [(i, "\n".join([f"line {i} number {j} stands here alone" for j in range(10)] + ["this line is in every document"])) for i in range(n)]
        got = line_dedup.line_digest(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        assert sum(r.n_dropped for r in got) == n - 1
        # every repeated line is a suspect, and under a tenth of the others
        assert n <= passed[-1] < n + 0.1 * 10 * n
    assert widths == [1 << 20, 1 << 22]


def test_simhash_small(awkward, nothing, pairs, spark):
    got = Counter(tuple(r) for r in simhash.near_duplicates(awkward).collect())
    assert sum(got.values()) == len(pairs)
    whole = [(d, t) for d, t in dict(pairs).items() if d is not None]
    df = spark.createDataFrame(whole, "doc_id long, text string")
    same(simhash.near_duplicates(df), simhash.brute_force(whole))
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_row_of_each_near_component_stays(spark):
    rnd = random.Random(8)
    base = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)) for _ in range(4)]
    near = [b + " end" for b in base]
    # null ids alone, a null copy of a numbered document, one id twice, and an equal row
    data = [(None, base[0]), (None, near[0]), (5, base[1]), (None, near[1]), (6, base[2]), (6, near[2]), (7, base[3]), (7, base[3])]
    df = spark.createDataFrame([(i, t, "s") for i, t in data], "doc_id long, text string, source string")
    assert len({r[1] for r in simhash.brute_force([(n, t) for n, t in enumerate(base + near)])}) > 4
    got = simhash.without_near_duplicates(df)
    assert got.columns == df.columns
    assert Counter((r.doc_id, next(i for i, b in enumerate(base) if r.text.startswith(b))) for r in got.collect()) == Counter([(None, 0), (5, 1), (6, 2), (7, 3)])


def test_gray_index_on_dense_groups(spark):
    """Groups of very close fingerprints over many pages, chains, and single ones."""
    rnd = random.Random(11)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for centre in (rnd.getrandbits(64), 0, 2**64 - 1):
        for _ in range(600):
            x = centre
            for b in rnd.sample(range(64), rnd.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    chain = rnd.getrandbits(64)
    for b in range(0, 60, 4):
        fps.add(chain)
        chain ^= 0b1111 << b
    fps = sorted(fps)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    got = {r.id: r.root for r in simhash.components(simhash.links(df)).collect()}
    groups = defaultdict(set)
    for x in fps:
        groups[find(x)].add(signed(x))
    mine = defaultdict(set)
    for x in fps:
        mine[got.get(signed(x), signed(x))].add(signed(x))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


PAGES = [(1, "http://a/b c\r\nX: y", "<p>" + "é" * 700), (2, None, "<p>" + "é" * 700), (None, "u", "<p>" + "é" * 700), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"),
         (8, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 100), (9, "u", "x\r\n\r\n" * 40000), (9, "u", "x\r\n\r\n" * 40000), (10, "u", "\n" * 1000), (11, "u", "z" * 65536)]


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_warc(spark, chunk):
    pages = PAGES if chunk > 100 else [(i, u, (h or "")[:1500] if h is not None else h) for i, u, h in PAGES]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, payload string, n int")
    group = defaultdict(list)
    for i, _, h in pages:
        group[h or ""].append(i)
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        top = max((x for x in group[h or ""] if x is not None), default=None)
        again = len(b) >= 1000 and i != top
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None, True))
    same(warc.archived_pages(df, chunk_bytes=chunk), want)


def test_warc_chunks_hold_the_payload(spark):
    from shelfline.session import scratch_path

    df = spark.createDataFrame([(1, "u", "abé" * 50), (2, "u", "")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path, chunk_bytes=10)
    got = sorted(warc.read_archives(spark, path, chunk_bytes=10).collect(), key=lambda r: (r.record_id, r.chunk_no))
    assert b"".join(r.data for r in got if r.record_id == "<urn:page:1>") == ("abé" * 50).encode()
    assert max(len(r.data) for r in got) <= 10 and [r.last for r in got].count(True) == 2
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_bpe(awkward, nothing, pairs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    same(bpe.token_digest(awkward, VOCABULARY), want)
    assert bpe.token_digest(nothing, VOCABULARY).count() == 0
    assert bpe.encoded(awkward, VOCABULARY).filter("decoded is null").count() == 0


def test_bpe_random_texts():
    t, own, rnd = Tokenizer.from_file(VOCABULARY), bpe.PrefixEncoder(VOCABULARY), random.Random(2)
    texts = ["".join(rnd.choice("  \n\tabcdefghiklmnoprstuéß日1234567890.,!'-<|>endoftx 　\U0001f389") for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    assert [[i for x in coded for i in x[0]] for coded in own.encode_texts(texts)] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_bpe_borders_of_tokens():
    """Following the parts at a border says the same as merging both tokens together."""
    own, rnd = bpe.PrefixEncoder(VOCABULARY), random.Random(7)
    tokens = [i for i in own.bytes_of if i not in own.special.values() and own.alone(i)]
    short, same_byte = [i for i in tokens if own.size_of[i] < 4], [i for i in tokens if len(set(own.bytes_of[i])) == 1]
    seen = set()
    for k in range(6000):
        a, b = rnd.choice((tokens, short, same_byte)[k % 3]), rnd.choice((tokens, short, same_byte)[k % 3])
        x, y = own.bytes_of[a], own.bytes_of[b]
        seen.add(own.fits(a, b))
        assert own.fits(a, b) == (own.merge(x + y) == [x, y])
    assert seen == {True, False}


def test_bpe_generations_of_pieces(monkeypatch):
    """Pieces that fell out of memory are encoded again and give the same."""
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    t, own, rnd = Tokenizer.from_file(VOCABULARY), bpe.PrefixEncoder(VOCABULARY), random.Random(6)
    for _ in range(200):
        texts = [" ".join(rnd.choice(("one", "two", "three", "vier", "fünf", "<|endoftext|>", "\n")) for _ in range(rnd.randint(0, 5))) for _ in range(2)]
        got = list(own.encode_texts(texts))
        assert [[i for x in coded for i in x[0]] for coded in got] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
        assert [bpe.decoded(coded) for coded in got] == texts and [",".join(x[1] for x in coded) for coded in got] == [",".join(str(i) for x in coded for i in x[0]) for coded in got]


def test_mtree(spark):
    rnd = random.Random(4)
    vec = lambda n=8: [rnd.gauss(0, 1) for _ in range(n)]
    data = [(i, vec()) for i in range(600)] + [(600 + i, [1.0] * 8) for i in range(400)] + [(1000 + i, vec(5)) for i in range(60)]
    data += [(5000, None), (5050, [float("nan")] * 8), (5100, [1.0, None]), (5150, [float("inf")]), (None, vec()), data[50], data[50], (5200, [])]
    df = spark.createDataFrame([(i, v, 0, 1.0) for i, v in data], "vec_id long, embedding array<double>, region int, score double")
    import math
    ok = {i: [math.floor(256 * x) for x in v] for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    same(mtree.top_inner_products(df, sample=64, pivots=6), want)
    same(mtree.top_inner_products(df.filter("vec_id in (50, 51)")), [w for w in [(50, 1, 51, sum(a * b for a, b in zip(ok[50], ok[51])))]])
    assert mtree.top_inner_products(df.limit(0)).count() == 0


def test_mtree_finds_k_ids_where_ids_share_rows(spark):
    rnd = random.Random(10)
    data = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    data += [(i, [rnd.choice((-3.0, 3.0)) + rnd.random() for _ in range(4)]) for i in (7, 8, 50) for _ in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = []
    whole = [(i, [int(256 * x // 1) for x in v]) for i, v in data]
    for q in (0, 50, 100):
        best = {}
        for i, v in whole:
            for j, w in whole:
                if i == q != j:
                    best[j] = max(best.get(j, -10**12), sum(a * b for a, b in zip(v, w)))
        want += [(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5])]
    same(mtree.top_inner_products(df, sample=64, pivots=6), want)
    same(mtree.top_inner_products(df), want)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    bad, good = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    auc = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert auc > 0.95
    assert sum(r.predicted for r in got if not r.toxic) <= 0.01 * len(good)
    assert sum(r.predicted for r in got if r.toxic) >= 0.8 * len(bad)


def test_calibration_gives_the_rates_of_the_labels():
    rnd = np.random.default_rng(3)
    odds = rnd.normal(-3, 3, 20_000)
    label = (rnd.random(20_000) < 1 / (1 + np.exp(-(0.5 * odds + 1)))).astype(float)
    slope, shift = toxicity.calibration(odds, label)
    assert abs(slope - 0.5) < 0.05 and abs(shift - 1) < 0.1
    # odds that say nothing are left alone
    assert toxicity.calibration(np.zeros(10), np.array([0.0, 1.0] * 5)) == pytest.approx((1.0, 0.0))
    assert toxicity.calibration(-odds, label) == (1.0, 0.0)


def test_toxicity_edges(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(0, 1, 0), (4, None, 1), (5, 1, None), (None, 1, 1), (12, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        got = toxicity.toxicity(awkward, labels).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
        assert toxicity.toxicity(nothing, labels).count() == 0
    kept = toxicity.without_toxic(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == len(rows())


def test_shouts_over_the_whole_text():
    calm, loud = "these are calm words, " * 300, "ÄRGER AND NOISE! " * 300
    shouts = lambda text: toxicity.votes(text, set(), 0) & 1
    assert shouts(calm + loud * 3) and not shouts(loud + calm * 3)
    assert shouts(loud) and not shouts(calm) and not shouts("LOUD") and not shouts("")


def test_every_lexicon_word_votes_beside_a_full_sample(spark):
    rnd = random.Random(6)
    made = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(60)]
    docs = [(i, " ".join(made) if i % 4 == 0 else "calm words of a quiet text") for i in range(600)] + [(1000 + i, " ".join([*made, "basura"])) for i in range(50)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(600)]
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    voters = len(model.labels.toxic) - len(toxicity.PATTERNS)
    at = {w: model.terms[w + "$"] for w in toxicity.LEXICON}
    assert voters == 48 + len(toxicity.LEXICON) and max(at.values()) < voters
    # the documents without a label show that it fires where others do
    assert model.labels.toxic[at["basura"]] > 0.1 > 0.02 > model.labels.toxic[at["connard"]]
    fired = model.labels.fired(np.array([[1 << 62, 1], [1, 1 << 3]]))
    assert [np.flatnonzero(x).tolist() for x in fired] == [[62, 63], [0, 66]]


def test_label_model_counts_correlated_voters_less():
    import numpy as np

    rnd = np.random.default_rng(0)
    y = rnd.random(20000) < 0.2
    vote = lambda a, b: np.where(y, rnd.random(len(y)) < a, rnd.random(len(y)) < b)
    one = vote(0.6, 0.05)
    v = np.stack([one, one, vote(0.7, 0.1), vote(0.5, 0.02)], axis=1)
    masks = (v * (1 << np.arange(4))).sum(axis=1)
    model = toxicity.LabelModel(0.2, np.full(4, 0.5), np.full(4, 0.1), np.ones(4))

    class Frame:
        """Stands for the counted patterns: one batch, summed in place."""

        def mapInArrow(self, f, schema):
            m, n = np.unique(masks, return_counts=True)
            self.out = [r for b in f(iter([pa.record_batch({"mask": m, "n": n})])) for r in b.to_pylist()]
            return self

        def groupBy(self, *a):
            return self

        def agg(self, *a):
            return self

        def collect(self):
            return self.out

    for _ in range(10):
        model = model.refit(Frame())
    assert model.weight[0] < 0.7 and model.weight[2] > 0.9
    assert abs(model.toxic[2] - 0.7) < 0.1 and abs(model.clean[2] - 0.1) < 0.05
    assert ((model.posterior(masks) > 0.5) == y).mean() > 0.9
