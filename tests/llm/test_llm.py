import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from almagest.llm import boosting, chat, components, exact_dedup, html_extract, langid, line_dedup, pieces, simhash, toxicity, warc, winnow
from almagest.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, extra=False):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)
    return df.withColumns({"fp": F.lit(1), "_w": F.lit("x"), "digest": F.lit("y"), "root": F.lit(0), "_al_host": F.lit("z")}) if extra else df


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.execute(Q.ORACLE_SQL[name])
    names = [x[0] for x in rel.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str([r[c] for c in names]) for r in df.collect()) == sorted(str(list(r)) for r in rel.fetchall())


# -- pieces


@pytest.fixture(scope="session")
def coder():
    return pieces.PieceCoder(pieces.load_model(Q.piece_model()))


@pytest.fixture(scope="session")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=Q.piece_model())


def test_pieces_equal_library(spark, coder, library):
    rng = random.Random(5)
    alphabet = "ab cd e▁ \n\t the in er on 1234 é ñ 你好 😀 \u0000 <s> <0x41> ÿ ﬁ .,!²"
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["", " ", "  ", "\n", "a", " a  b ", "▁", "x" * 3000, "aeinrst" * 500, " " * 70]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    import pyarrow as pa

    done = [r for i in range(0, len(texts), 500) for r in coder.encode_batch(pa.array(texts[i : i + 500]))]
    for t, (n, ids, back) in zip(texts, done, strict=True):
        want = library.encode(t)
        assert coder.encode(t) == want and n == len(want) and ids.decode() == ",".join(map(str, want))
        assert back.decode() == library.decode(want)


def test_decode_any_ids(coder, library):
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))]
        assert coder.decode(ids) == library.decode(ids)


def test_pairs_are_judged_without_merging_again(coder, monkeypatch):
    rng, names = random.Random(3), sorted(coder.shorter)
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(400)]
    pairs += [(p[:k], p[k:]) for p in rng.sample(names, 400) for k in range(1, len(p)) if p[:k] in coder.shorter and p[k:] in coder.shorter]
    want = [coder.merge(a + b) == [a, b] for a, b in pairs]
    assert {*want} == {True, False}
    merged, merge = [], coder.merge
    monkeypatch.setattr(coder, "merge", lambda s, *more: merged.append(s) or merge(s, *more))
    coder.pairs.clear()
    assert [coder.fits(a, b) for a, b in pairs] == want
    assert {*merged} <= {x for pair in pairs for x in pair}


def test_kept_words_are_their_ids_alone(coder, library):
    """Of a known word only the ids are kept, and words with signs behind share what is kept of the bare word."""
    import pyarrow as pa

    texts = ["sharedword. sharedword, new\nsharedword!", "sharedword", "你好 odd 😀x \u0378. known", "ﬁ \u0378\u0378"]
    done = coder.encode_batch(pa.array(texts))
    assert [(ids.decode(), back.decode()) for _, ids, back in done] == [(",".join(map(str, i)), library.decode(i)) for i in map(library.encode, texts)]
    assert coder.words["sharedword"] == ",".join(map(str, library.encode("sharedword"))) == coder.words["sharedword."].rpartition(",")[0]


@pytest.mark.parametrize("seed", range(6))
def test_small_models_equal_merging(monkeypatch, seed):
    """Stretches that need many steps back, with caches that overflow all the time."""
    for name in ("CACHE_WORDS", "CACHE_CHUNKS", "CACHE_PAIRS"):
        monkeypatch.setattr(pieces, name, 5)
    rng = random.Random(seed)
    names = ["a", "b", "c", "▁"]
    while len(names) < 60:
        p = rng.choice(names) + rng.choice(names)
        if len(p) <= 9 and "▁" not in p[1:] and p not in names:
            names.append(p)
    model = {"pieces": [("<unk>", 0.0, pieces.UNKNOWN), *((p, -float(i), pieces.NORMAL) for i, p in enumerate(names))], "prefix": True, "unk_surface": " ? ", "byte_fallback": False}
    coder, back = pieces.PieceCoder(model), 0
    for _ in range(300):
        text = "".join(rng.choice("abc" * 6 + " ") for _ in range(rng.randint(1, 80)))
        got = coder.encode(text)
        assert [coder.names[i] for i in got] == coder.merge("▁" + text.replace(" ", "▁"))
        assert coder.decode(got) == text
        back += any(v < 0 for v in [*coder.pairs.values(), *coder.old_pairs.values()])
    assert back


def test_pieces_rows(spark, library):
    out = {r.doc_id: r for r in pieces.encode_texts(docs(spark, [None, "", "héllo  wörld"], True), Q.piece_model(), ids=True).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (out[0].n_tokens, out[0].ids_sha256, out[1].decoded_sha256, out[0].ids) == (0, empty, empty, [])
    assert out[2].ids == library.encode("héllo  wörld")
    assert pieces.encode_texts(docs(spark, []), Q.piece_model()).count() == 0


def test_models_have_keys_of_their_own(spark):
    """A worker that has coded with one model codes right with one that differs in a flag only."""
    model = pieces.load_model(Q.piece_model())
    keys = [pieces._Shared(spark, m).id for m in (model, model | {"prefix": not model["prefix"]}, dict(model), model | {"pieces": [(p, v + 1, k) for p, v, k in model["pieces"]]})]
    assert keys[0] == keys[2] and len(set(keys)) == 3


# -- simhash


def _fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _classes(fps):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: _fp(r.text) for r in rows}
    want = _classes(fps)
    got = {r.doc_id: r for r in Q.op5_simhash(spark, SF).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == want


@pytest.mark.parametrize("cut,crowd", [(simhash.CUTS[0], 4096), (simhash.CUTS[1], 4096), (simhash.CUTS[0], 2)])
def test_links_lose_nothing(spark, monkeypatch, cut, crowd):
    """By both cuts, and with full segment values dealt to several tasks."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:20]:
        for _ in range(12):  # families of light edits, some at exactly four bits
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5]))))
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp bigint, low bigint")
    first = simhash._neighbours(nodes, 0, 4).union(simhash._neighbours(nodes, 21, 4)).union(simhash._neighbours(nodes, 42, 4))
    fam = components.components(first)
    found = simhash.links(nodes, fam, cut=cut)
    got = components.components(found.union(fam.where("node <> root").select("node", "root"))).collect()
    mask = (1 << 64) - 1
    want = _classes({f: f & mask for f in signed})
    roots = {r.node: r.root for r in got}
    for f in signed:
        assert roots.get(f, f) == want[f]


def test_simhash_edges(spark):
    out = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, [None, "", "A b", "a  B", "x y z w v"], True)).collect()}
    assert [out[i].component_id for i in range(5)] == [0, 0, 2, 2, 4] and out[0].fingerprint == "0" * 16
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_cut_follows_the_number_of_fingerprints():
    """Ten times the fingerprints is ten times the work, give or take a third, up to a hundred billion."""
    work = lambda n: n * sum(len(simhash._ball(b, r)) * (1 + n / (1 << b)) for _, b, r in simhash.plan(n))
    assert simhash.plan(10**6) == simhash.CUTS[0] and simhash.plan(10**9) == simhash.CUTS[1]
    assert all(sum(r for *_, r in c) == simhash.MAX_BITS - len(c) + 1 and sum(b for _, b, _ in c) == 64 for c in simhash.CUTS)
    assert work(10**9) / work(10**8) < 13 and [len(simhash._ball(b, r)) for _, b, r in simhash.CUTS[1]] == [529, 33]


def test_components_of_a_hub(spark, monkeypatch):
    """A node whose links are met by broadcast gives the same components."""
    edges = spark.range(1, 400).select(F.lit(400).cast("bigint").alias("a"), F.col("id").alias("b")).union(spark.range(500, 520).select("id", F.col("id") + 1))
    want = sorted(map(tuple, components.components(edges).collect()))
    monkeypatch.setattr(components, "HUB_LINKS", 50)
    monkeypatch.setattr(components, "HUBS", 10)
    assert sorted(map(tuple, components.components(edges).collect())) == want and len(want) == 421


def test_components_are_light_on_the_driver(spark, monkeypatch):
    """A long chain is settled in two tables, and no join in its rounds is a broadcast."""
    wrote = []

    def spy(df, tag):
        wrote.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, tag)

    materialize = components.materialize
    monkeypatch.setattr(components, "materialize", spy)
    chain = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.components(chain).collect()} == {0}
    assert len(wrote) == 2 and "SortMergeJoin" in wrote[1] and not any("BroadcastHashJoin" in p for p in wrote)


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_components_contracted_by_parts(spark, monkeypatch, at_once):
    monkeypatch.setattr(components, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    pairs = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    root = {n: n for p in pairs if p[0] != p[1] for n in p}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted(root.items())


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Up to ``alone`` links are settled by one task, as near duplicates ask for; one more takes rounds with the same result."""
    rng = random.Random(3)
    edges = spark.createDataFrame([(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)], "a bigint, b bigint").repartition(9).persist()
    want = sorted(map(tuple, components.components(edges).collect()))
    rounds, large = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda *args: rounds.append(args[1]) or large(*args))
    assert sorted(map(tuple, components.components(edges, alone=250_000).collect())) == want and not rounds
    assert sorted(map(tuple, components.components(edges, alone=1).collect())) == want and rounds
    texts = edges.where("a <> b").select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    rounds.clear()
    assert len(components.components(texts, alone=250_000).collect()) == len(want) and rounds
    rounds.clear()
    words = [f"w{i}" for i in range(60)]
    out = simhash.near_duplicates(docs(spark, [" ".join(words), " ".join([*words, "end"]), "other text of its own"], True)).collect()
    assert len({r.component_id for r in out}) == 2 and not rounds


def test_components_of_a_chain(spark):
    got = components.components(spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))).collect()
    assert {r.node for r in got} == set(range(41)) and {r.root for r in got} == {0}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- exact duplicates


def _exact(rows):
    groups = {}
    for i, (k, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), k is None, k or 0, i, k))
    return {i: (min(g)[4], len(g), i == min(g)[3]) for g in groups.values() for *_, i, _k in g}


@pytest.mark.parametrize("digest,limit", [(exact_dedup.sha256, 1 << 20), (exact_dedup.sha256, 600), (lambda b: bytes([len(b) % 2]), 600)])
def test_exact_equals_brute_force(spark, digest, limit):
    """Also with tiny memtables, and with a digest of one byte so that only bytes tell texts apart."""
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "ab", "a b", "c", "", None, "d" * 300, "D\n", "d "])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = exact_dedup.exact_duplicates(df, digest=digest, memtable_bytes=limit).collect()
    want = _exact(rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == want
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0


def test_exact_index_over_several_tables(spark):
    """Level 1 takes up new runs; a lookup finds what is there and nothing else; runs are in digest order."""
    import glob

    import pyarrow.parquet as pq

    index = exact_dedup.MergeIndex(spark, memtable_bytes=2000)
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    index.ingest(spark.range(300).selectExpr("id + 10 as doc_id", "concat('t', id % 100) as text").repartition(3))
    first = {bytes(r.digest): (r.keep_id, r.group_size) for r in index.compact().collect()}
    assert len(first) == 100 and first[sha("t0")] == (10, 3)
    for path in glob.glob(index.runs[0].removeprefix("file://") + "/*.parquet"):
        got = pq.read_table(path, columns=["digest"]).column(0).to_pylist()
        assert got == sorted(got)
    index.ingest(spark.createDataFrame([(1, "t 0"), (2, "new"), (None, "t0"), (99, None)], "doc_id bigint, text string"))
    got = {bytes(r.digest): (r.keep_id, r.group_size) for r in index.lookup([sha("t0"), sha("t1"), sha("new"), sha(""), sha("absent")]).collect()}
    assert got == {sha("t0"): (1, 5), sha("t1"): (11, 3), sha("new"): (2, 1), sha(""): (99, 1)}
    assert index.compact().count() == 102
    with pytest.raises(ValueError, match="ids are bigint"):
        index.ingest(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_exact_keeps_to_its_columns(spark):
    """Columns with names of its own do not disturb it."""
    got = exact_dedup.exact_duplicates(docs(spark, ["a", "a ", "b"], extra=True).withColumns({"variant": F.lit(3), "keep_id": F.lit(9), "rid": F.lit("r")}))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == [(0, 1, 2, False), (1, 1, 2, True), (2, 2, 1, True)]


def test_exact_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(7, "x"), (7, "x"), (None, "x "), (None, None)], "doc_id bigint, text string")
    got = exact_dedup.exact_duplicates(df).collect()
    assert len(got) == 4 and sum(r.kept for r in got) == 2


# -- decontamination


def test_winnowing_equals_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    vocab = ["a", "b", "c", "é1", "d"]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (1, 2, 4, 5, 7, 12, 13, 14, 30, 0)] + [None, "z " * 20]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 80))) for _ in range(40)] + [None, "", "--"] + [f"q w, {items[8]} r" for _ in range(2)] + ["Z " * 25, items[7].upper()]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {r.doc_id: r for r in winnow.decontaminate(docs(spark, texts, True), bench).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    for i, t in enumerate(texts):
        w, hit, ids = split(t), set(), set()
        for j, it in enumerate(items):
            v = split(it)
            k = min(13, len(v))
            for s in range(len(v) - k + 1) if k else ():
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == v[s : s + k]:
                        hit |= set(range(p, p + k))
                        ids.add(str(j))
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert winnow.decontaminate(docs(spark, ["a b"]), bench.limit(0)).first().n_hit == 0
    # a benchmark too large to broadcast gives the same rows
    monkeypatch.setattr(winnow, "BROADCAST_BYTES", 0)
    again = {r.doc_id: r for r in winnow.decontaminate(docs(spark, texts, True), bench).collect()}
    assert again == got


def test_decontamination_of_repeated_rows_and_shared_items(spark):
    """Each of equal rows has its result; a passage of thousands of items is looked up once; long texts and ties."""
    passage = " ".join(f"w{i}" for i in range(40))
    bench = spark.range(3000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit(passage).alias("text"))
    rows = [(1, passage)] * 25 + [(1, passage + " end")] * 2 + [(None, passage)] * 3 + [(2, None)] * 4 + [(3, "clean text " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = winnow.decontaminate(df, bench).groupBy("doc_id", "n_words", "n_hit", "n_items", "contaminated", "items_sha256").count().collect()
    want = hashlib.sha256(",".join(sorted(f"i{i}" for i in range(3000))).encode()).hexdigest()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated, r["count"]) for r in got) == [(0, 40, 40, 3000, True, 3), (1, 40, 40, 3000, True, 25), (1, 41, 40, 3000, True, 2), (2, 0, 0, 0, False, 4), (3, 200_000, 0, 0, False, 1)]
    assert {r.items_sha256 for r in got if r.n_hit} == {want}
    assert winnow._repeated(spark.createDataFrame([(25_000,), (1,), (10_000,)], "n bigint"), "n").groupBy("n").count().orderBy("n").collect() == [(1, 1), (10_000, 10_000), (25_000, 25_000)]


# -- toxicity, languages


def test_boosting_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = boosting.fit_trees(x, y, rounds=40)
    assert ((boosting.raw_scores(m, x) > 0) == (y > 0)).mean() > 0.95
    k = boosting.fit_isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert np.all(np.diff(k[1]) >= 0) and k[1][1] == 0.5


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = Q.op3_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    assert out.where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] > 0.93
    assert out.agg(F.min("score"), F.max("score")).first() >= (0.0, 0.5)
    empty = toxicity.toxicity(docs(spark, [None, ""], True), spark.createDataFrame([], "doc_id bigint, toxic int")).collect()
    assert len(empty) == 2 and all(0 <= r.score <= 1 for r in empty)


def _plain_features(text, lex):
    """The features, word by word."""
    w = re.findall(r"[^\W_]+", text.lower())
    t = text.split()
    if not w:
        return [0.0] * 15
    hit, stem, you = ([x in lex["words"] for x in w], [x[:5] in lex["stems"] for x in w], [x in lex["second"] for x in w])
    any_hit = [a or b for a, b in zip(hit, stem, strict=True)]
    near = sum(1 for i, h in enumerate(any_hit) if h and any(you[max(0, i - 4) : i + 5]))
    letters = sum(c.isalpha() for c in text) or 1
    odd = [x.lower().strip(".,;:!?") for x in t if re.search(r"[0134570@$!*]", x)]
    mixed = sum(1 for x in odd if re.search(r"[^\W\d_]", x) and re.search(r"[\d@$*]", x))
    clear = lambda x: "".join(toxicity.LEET.get(c, c) for c in x)
    leet = sum(1 for x in odd if x not in lex["words"] and (clear(x) in lex["words"] or clear(x)[:5] in lex["stems"] and clear(x) != x))
    most = max(sum(any_hit[i : i + 50]) for i in range(len(w)))
    n, k = len(w), len(t)
    return [n, sum(hit) / n, sum(stem) / n, sum(hit), sum(stem), near / n, sum(you) / n, sum(1 for x in t if len(x) > 1 and x.isupper()) / k, sum(c.isupper() for c in text) / letters, text.count("!") / k, (len(text) - letters - sum(c.isspace() for c in text)) / len(text), leet / k, mixed / k, sum(1 for x in t if re.search(r"(\w)\1\1", x)) / k, most]


def _plain_score(x, model):
    raw = model["trees"]["base"]
    for feature, cut, value in model["trees"]["trees"]:
        node = 0
        while feature[node] >= 0:
            node = 2 * node + 1 + (x[feature[node]] > cut[node])
        raw += model["trees"]["rate"] * value[node]
    at, to = model["knots"]
    if raw <= at[0]:
        flat = to[0]
    elif raw >= at[-1]:
        flat = to[-1]
    else:
        i = max(j for j in range(len(at)) if at[j] <= raw)
        flat = to[i] + (to[i + 1] - to[i]) * (raw - at[i]) / (at[i + 1] - at[i])
    return min(1, max(0, 0.99 * flat + 0.01 / (1 + np.exp(-max(-30, min(30, raw))))))


def test_toxicity_equals_plain_python(spark):
    """Scores from the model's lists, trees and knots, worked out one text at a time."""
    d = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.train(source, spark.read.parquet(f"{d}/labels.parquet"))
    rows = source.where("length(text) < 3000").orderBy(F.xxhash64("doc_id")).limit(150).select("doc_id", "text")
    word, stem = sorted(model["lex"]["words"])[0], sorted(model["lex"]["stems"])[0]
    more = [(-1, None), (-2, ""), (-3, "!!! ..."), (-4, f"you {stem}x are {word.upper()} YOU"), (-5, f"{stem}zz du"), (-6, "aaaa h3ll0 @b " + word[:1] + word[1:].replace("i", "1"))]
    rows = spark.createDataFrame([tuple(r) for r in rows.collect()] + more, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}
    for r in rows.collect():
        assert got[r.doc_id] == pytest.approx(_plain_score(_plain_features(r.text or "", model["lex"]), model), abs=1e-9)
    assert _plain_features(f"{stem}zz du", model["lex"])[5] > 0


@pytest.mark.parametrize("kind", ["bigint", "boolean", "double", "string", "tinyint"])
def test_toxicity_label_types(spark, kind):
    rows = spark.createDataFrame([(i, f"text {i} " + ("vile slur " * 3 if i % 2 else "calm note ")) for i in range(60)], "doc_id bigint, text string")
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").cast(kind).alias("toxic")).unionByName(spark.sql(f"select 0L as doc_id, cast(null as {kind}) as toxic"))
    assert toxicity._training(rows, labels, 100).agg(F.sum("y")).first()[0] == rows.where("doc_id % 2 = 1 and crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").count()


def test_language_equals_plain_python(spark):
    """Similarity and language from the model's weights and centroids, gram by gram."""
    d = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{d}/documents.parquet")
    model = langid.train(source)
    rows = source.where("length(text) < 800").orderBy(F.xxhash64("doc_id")).limit(40).select("doc_id", "text").collect()
    rows = [tuple(r) for r in rows] + [(-1, "a"), (-2, "Ünï cödé"), (-3, "हिन्दी भाषा"), (-4, None), (-5, "12 _ 3")]
    got = {r.doc_id: r for r in langid.classify(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    mask = (1 << 64) - 1
    import unicodedata

    for i, text in rows:
        kept = "".join(c if unicodedata.category(c)[0] == "M" or c.isalnum() and not c.isdecimal() else " " for c in (text or "").lower())
        s = " ".join(kept.split())
        if not any(c.isalpha() for c in s):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        p = [ord(c) for c in f" {s} "]
        grams = [c for c in p if c != 32]
        pairs = [(p[j] * 0x110003 + p[j + 1]) & mask for j in range(len(p) - 1)]
        grams += [(x + (1 << 62)) & mask for x in pairs]
        grams += [(pairs[j] * 0x110003 + p[j + 2] + (1 << 61)) & mask for j in range(len(p) - 2) if p[j + 1] != 32]
        v = {}
        for g in grams:
            k = (g * 0x9E3779B97F4A7C15 & mask) >> (64 - langid.BITS)
            v[k] = v.get(k, 0) + 1
        v = {k: np.log1p(n) * model["idf"][k] for k, n in v.items()}
        size = np.sqrt(sum(x * x for x in v.values()))
        best = {}
        for c, of in zip(model["centroids"], model["of"], strict=True):
            best[of] = max(best.get(of, -1), sum(x * c[k] for k, x in v.items()) / size)
        top = max(best.values())
        assert got[i].similarity == pytest.approx(top, abs=1e-4) and best[model["langs"].index(got[i].lang_pred)] == pytest.approx(top, abs=1e-4)
        assert got[i].score == pytest.approx(1 / sum(np.exp(20 * (b - top)) for b in best.values()), abs=1e-3)


def test_language_ties_and_marks(spark):
    """Of two languages with the same centroid the first by name; marks stay inside words."""
    one = langid.train(docs(spark, []))
    assert one["langs"] == [] and langid.letters("हिन्दी ไม้ A1_b") == "हिन्दी ไม้ a b" and langid.letters("Été, 12 l’an_") == "été l an"
    rows = spark.createDataFrame([(i, "same words here", "ab"[i % 2]) for i in range(80)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in langid.identify(rows).collect()} == {"a"}


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = Q.op6_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert out.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.93
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs(spark, [None, "", "12 .", "words here", "more words", "and words"], True)).collect()}
    assert [got[i] for i in range(3)] == ["und"] * 3
    assert langid.identify(docs(spark, [])).count() == 0


def test_repeated_ids_are_learned_once(spark):
    rows = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(3, "other")], "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0)], "doc_id bigint, toxic int")
    assert toxicity._training(rows, labels, 10).where("doc_id = 1").collect() == [(1, 1, "text 0")]
    assert langid._training(rows, 10).where("doc_id = 1").count() <= 1


def test_every_language_is_learned(spark, monkeypatch):
    rows = spark.range(6000).selectExpr("id as doc_id", "concat('l', id % 450) as lang", "concat('text ', id) as text")
    assert langid._training(rows, 3).select("lang").distinct().count() == 450
    monkeypatch.setattr(langid, "TRAIN_ROWS", 900)
    many = langid._training(rows, 600).groupBy("lang").count().agg(F.count("*"), F.max("count")).first()
    assert tuple(many) == (450, 2)
    monkeypatch.setattr(langid, "TRAIN_ROWS", 1)
    one = rows.union(spark.range(6000, 9000).selectExpr("id", "'l0'", "'more'"))
    assert langid._training(one, 600).count() == 450


# -- lines, chats, captures, pages


def test_lines(spark):
    texts = ["menu\nown %d\n\nend %d" % (i, i) for i in range(30)] + [None, "", "menu"]
    out = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs(spark, texts, True), ratio=0.5).collect()}
    assert out[0].text == "own 0\n\nend 0" and out[0]._al_dropped == 1 and out[30].text is None and out[31].text == "" and out[32].text == ""
    assert line_dedup.line_report(docs(spark, [])).count() == 0


def test_line_parameters(spark, monkeypatch):
    """The caller's ratio and minimum decide alone; lists too long to broadcast give the same rows."""
    df = docs(spark, ["a\nb", "a\nc", "d", "e", "f"])
    cut = lambda **k: {r.doc_id: r.text for r in line_dedup.drop_boilerplate(df, **k).collect()}
    assert cut(ratio=0.1, held_by=1) == dict.fromkeys(range(5), "")
    assert cut(ratio=0.3, held_by=1) == cut(ratio=0.1, held_by=2) == {0: "b", 1: "c", 2: "d", 3: "e", 4: "f"}
    assert cut(ratio=0.5, held_by=1) == cut() == {0: "a\nb", 1: "a\nc", 2: "d", 3: "e", 4: "f"}
    want = cut(ratio=0.3, held_by=1)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    assert cut(ratio=0.3, held_by=1) == want


def test_line_query_where_lines_are_cut(spark, tmp_path):
    """Query and SQL on hosts of many and of few pages, with a null host; the stage cuts the same texts."""
    hosts = {"large": 30, "edge": 20, "small": 3, "two": 2, None: 25}
    rows = [(f"menu\n own {h} {i} \n\nmenu \nrare {i // 2}", h) for h, n in hosts.items() for i in range(n)] + [(None, "large"), ("", "large")]
    df = spark.createDataFrame([(i, t, "en", h, len(t or "")) for i, (t, h) in enumerate(rows)], DOCS)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(Q.ORACLE_SQL["op7_line_dedup"]).fetchall())
    got = sorted(tuple(r) for r in Q.op7_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "text_sha256").collect())
    assert got == want and {h: max(got[i][2] for i, r in enumerate(rows) if r[1] == h) for h in hosts} == {"large": 2, "edge": 2, "small": 2, "two": 0, None: 2}
    cut = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in corpus_pipeline.cut_boilerplate(spark, df, str(tmp_path)).collect()}
    assert cut == {r[0]: r[3] for r in got}


def test_chats(spark):
    a, b = ("user", "hi"), ("assistant", "yo")
    logs = {1: [a], 2: [a, b], 3: [a, b], 4: [a, ("assistant", "no")], 5: [(None, None)], 6: [a, b, ("user", "more")], 7: [("user", None)]}
    rows = [(c, i, r, t) for c, turns in logs.items() for i, (r, t) in enumerate(turns)] + [(None, 0, "user", "x"), (4, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n", F.lit(1))
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert set(got) == {4, 5, 6, 7} and got[6].n_turns == 3
    assert got[6].rendered.startswith("<|user|>\nhi\n<|end|>\n<|assistant|>\nyo")
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chats_of_long_texts_and_clashing_columns(spark):
    """A turn of a million words stays whole; names of working columns may be taken; a prefix of thousands of copies goes."""
    long = "word " * 1_000_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", "ok")] + [(10 + c, 0, "user", long) for c in range(3)] + [(1000 + c, 0, "user", "hi") for c in range(2000)] + [(5000, 0, "user", "hi"), (5000, 1, "assistant", "yo")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'k' as key", "1 as n", "true as last", "2 as _pos")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert set(got) == {1, 5000} and len(got[1].rendered) == len(long) + len("<|user|>\n\n<|end|>\n<|assistant|>\nok\n<|end|>\n")


def test_revisits(spark):
    rows = [("r1", "http://A.com:80/x?b=1&a=2#f", "2024-01-01 00:00:00", "response", 200, {"etag": '"1"', "content-type": "t", "date": "d1"}, b"one"), ("r2", "http://a.com/x?a=2&b=1", "2024-01-05 00:00:00", "response", 200, {"etag": 'W/"2"', "date": "d2"}, b"two"), ("r3", "http://a.com/x?a=2&b=1", "2024-01-06 00:00:00", "response", 500, {}, b"err")]
    rev = [("v1", "2024-01-01 05:00:00", {"etag": '"1"', "content-type": "no", "date": "n"}), ("v2", "2024-01-09 00:00:00", {"etag": '"2"'}), ("v3", "2024-01-09 00:00:01", {"etag": '"1"'}), ("v4", "2023-01-01 00:00:00", {"etag": '"1"'}), ("v5", "2024-01-09 00:00:02", {}), ("v6", "2024-01-05 00:00:00", {"etag": '"1"'})]
    rows += [(i, "http://a.com/x?a=2&utm_source=q&b=1", t, "revisit", 304, h, None) for i, t, h in rev] + [("v7", None, None, "revisit", 304, None, None)]
    df = spark.createDataFrame(rows, "record_id string, url string, ts string, kind string, status int, headers map<string,string>, payload binary").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.record_id: r for r in warc.resolve_revisits(df.withColumn("curl", F.lit("clash"))).collect()}
    assert {k: (r.state, r.source_id) for k, r in got.items()} == {"v1": ("RESOLVED", "r1"), "v2": ("RESOLVED", "r2"), "v3": ("VALIDATOR_MISMATCH", "r2"), "v4": ("NO_EARLIER_RESPONSE", None), "v5": ("NO_COMMON_VALIDATOR", "r2"), "v6": ("RESOLVED", "r1"), "v7": ("NO_EARLIER_RESPONSE", None)}
    assert got["v1"].headers == {"etag": '"1"', "content-type": "t", "date": "n"} and bytes(got["v1"].payload) == b"one"


@pytest.mark.parametrize("sources", [10**6, 0])
def test_revisits_with_null_and_repeated_ids(spark, monkeypatch, sources):
    """One row for each revisit, whatever the ids; a response is found by its row, not by its id."""
    monkeypatch.setattr(warc, "BROADCAST_SOURCES", sources)
    shape = "record_id string, url string, ts string, kind string, status int, headers map<string,string>, payload binary"
    hit = lambda i, p: (i, "http://a.com/x", "2024-01-01 00:00:00", "response", 200, {"etag": "1", "x": p.decode()}, p)
    again = lambda i, tag="1": (i, "http://a.com/x", "2024-01-02 00:00:00", "revisit", 304, {"etag": tag}, None)
    rows = [hit("r", b"one")] * 4 + [again("v")] * 4 + [again(None)] * 3 + [again("w", "2")] * 2 + [(None, None, None, "revisit", 304, None, None)] * 2
    got = warc.resolve_revisits(spark.createDataFrame(rows, shape).withColumn("ts", F.col("ts").cast("timestamp")).repartition(3)).collect()
    assert sorted((r.record_id or "", r.state, bytes(r.payload or b"")) for r in got) == [("", "NO_EARLIER_RESPONSE", b"")] * 2 + [("", "RESOLVED", b"one")] * 3 + [("v", "RESOLVED", b"one")] * 4 + [("w", "VALIDATOR_MISMATCH", b"")] * 2
    rows = [hit(None, b"p"), hit(None, b"q"), again("v"), again("v")]
    got = warc.resolve_revisits(spark.createDataFrame(rows, shape).withColumn("ts", F.col("ts").cast("timestamp")).repartition(3)).collect()
    assert len(got) == 2 and {r.state for r in got} == {"RESOLVED"} and len({(r.headers["x"], bytes(r.payload)) for r in got}) == 1
    assert all(r.headers["x"] == bytes(r.payload).decode() for r in got)


def test_revisits_of_null_and_repeated_pages(spark, tmp_path):
    """The query keeps the revisits of null page ids, as its SQL does, and gives one row for each of repeated pages."""
    page = [(3, "http://a/3", "<p>x</p>"), (5, "http://a/5", None), (None, "http://a/n", "<p>n</p>"), (None, None, "m")]
    read = lambda rows: (spark.createDataFrame(rows, "page_id bigint, url string, html string").write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet"), Q.op8_warc_revisits(spark, str(tmp_path)))[1]
    df = read(page)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    rel = con.execute(Q.ORACLE_SQL["op8_warc_revisits"])
    names = [x[0] for x in rel.description]
    one = sorted(str([r[c] for c in names]) for r in df.collect())
    assert one == sorted(str(list(r)) for r in rel.fetchall()) and len(one) == 5
    assert sorted(str([r[c] for c in names]) for r in read(page * 6).collect()) == sorted(one * 6)
    assert sorted(str(list(r)) for r in con.execute(Q.ORACLE_SQL["op8_warc_revisits"]).fetchall()) == sorted(one * 6)
    assert read(page).limit(0).count() == 0 and warc.resolve_revisits(warc.page_captures(spark.createDataFrame([], "page_id bigint, url string, html string"))).count() == 0


def test_warc_files(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nETag: x\r\n\r\nhello"
    (tmp_path / "a.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <1>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body))
    r = warc.read_warc(spark, str(tmp_path)).first()
    assert (r.kind, r.status, r.headers, bytes(r.payload)) == ("response", 200, {"etag": "x"}, b"hello")


def test_warc_streams_malformed_and_compressed(spark, tmp_path, monkeypatch):
    """Records come in batches; one without a length has no payload; a cut file keeps what it has; gzip by record."""
    import gzip

    one = lambda i, body, size=None: b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <%d>\r\nContent-Length: %s\r\n\r\n%s\r\n\r\n" % (i, size or str(len(body)).encode(), body)
    (tmp_path / "b c.warc.gz").write_bytes(b"".join(gzip.compress(one(i, b"x" * i)) for i in range(1200)))
    (tmp_path / "bad.warc").write_bytes(b"noise\n" + one(5000, b"lost", b"many") + one(5001, b"good") + one(5002, b"cut", b"900"))
    (tmp_path / "none.warc").write_bytes(b"")
    monkeypatch.setattr(warc, "PASSED_BYTES", 10_000)
    got = {int(r.record_id[1:-1]): r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert len(got) == 1203 and all(len(got[i].payload) == i for i in range(1200))
    assert got[5000].payload is None and bytes(got[5001].payload) == b"good" and bytes(got[5002].payload).startswith(b"cut") and got[5001].ts is None
    frames = list(warc._framed(warc.parse_warc(b"".join(one(i, b"x" * 4000) for i in range(9)))))
    assert [len(f) for f in frames] == [3, 3, 3]


def test_html():
    page = '<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><a href=1>Home</a></nav><div class="ad">Buy now all of it.</div><article><h1>Head &amp; line</h1><p>One <b>two\n three<br>four<p>A &lt;b&gt; c<div class="comments"><p>I like it a lot, thanks.</p></div></article><form><p>Mail us your address.</p></form><footer>&copy; x</footer>'
    assert html_extract.main_text(page) == "Head & line\nOne two three\nfour\nA <b> c"
    assert html_extract.main_text(None) == "" and html_extract.main_text("<p") == ""


def test_html_attributes():
    page = '<article><p>One <a title="hidden gem" href="x">two</a> <span aria-hidden="true">three</span> <i data-id=nav>four</i> <b hidden>no</b></p></article>'
    assert html_extract.main_text(page) == "One two three four"


def test_html_short_blocks_and_layout_names():
    long = "The council spoke about the harbour, what it costs and how long the work on its walls will take from now on."
    page = f'<body><div><a href=1>Home</a> <a href=2>About</a></div><div><h1>Harbour</h1><p>{long}</p><p>It is late.</p><p>{long} Read <a href=3>all of it</a>.</p><p>Or <a href=4>a part</a> now.</p><ul><li>One item</li></ul><table><tr><td>a cell</td></tr></table></div><div><a href=5>Older</a></div><div class="site-footer"><p>All rights kept.</p></div></body>'
    assert html_extract.main_text(page) == f"Harbour\n{long}\nIt is late.\n{long} Read all of it.\nOr a part now.\nOne item\na cell"
    for name in ("has-sidebar", "header-fixed", "no-ads"):
        page = f'<div class="{name}"><div><article><h1>Harbour</h1><p>{long}</p><div class="ad-box"><p>Buy now.</p></div></article></div><div class="sidebar"><p>Read more here.</p></div></div>'
        assert html_extract.main_text(page) == f"Harbour\n{long}"
    assert html_extract.main_text(f'<div class="comments"><article><p>{long}</p></article></div>') == ""


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, "<article><p>é x</p></article>")], "page_id bigint, url string, html string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert (got[1].text, got[1].n_chars, got[2].text, got[2].n_chars) == ("", 0, "é x", 3)


# -- pipeline


def _item_windows(items):
    """Windows of 13 words of each item, or all of a shorter one."""
    out = {}
    for i, t in items:
        w = _words(t)
        k = min(13, len(w))
        for p in range(len(w) - k + 1) if k else ():
            out.setdefault(k, {}).setdefault(tuple(w[p : p + k]), set()).add(i)
    return out


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def _contaminated(text, windows):
    w, hit = _words(text), set()
    for k, known in windows.items():
        for p in range(len(w) - k + 1):
            if tuple(w[p : p + k]) in known:
                hit |= set(range(p, p + k))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline_by_brute_force(spark, library):
    """The stages' decisions, each made again in plain Python, the toxicity model's lists and trees given."""
    d = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{d}/documents.parquet")
    table = {r.doc_id: r for r in source.collect()}
    model = toxicity.train(source, spark.read.parquet(f"{d}/labels.parquet"))
    left = {i: r.text for i, r in table.items() if _plain_score(_plain_features(r.text or "", model["lex"]), model) < 0.5}
    hosts = {}
    for i in left:
        hosts.setdefault(table[i].source, []).append(i)
    for ids in hosts.values():
        seen = {}
        for i in ids:
            for x in {x.strip(" ") for x in left[i].split("\n")} - {""}:
                seen[x] = seen.get(x, 0) + 1
        bad = {x for x, n in seen.items() if n >= line_dedup.HELD_BY and n > len(ids) * line_dedup.RATIO}
        for i in ids:
            left[i] = "\n".join(x for x in left[i].split("\n") if x.strip(" ") not in bad)
    root = _classes({i: _fp(t) for i, t in left.items()})
    windows = _item_windows((r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect())
    want = {i: library.encode(t) for i, t in left.items() if root[i] == i and not _contaminated(t, windows)}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, d).collect()} == want


def test_pipeline_stages_on_rows_without_ids(spark):
    """Groups and contaminated texts go under a null id as under any other; names of working columns may be taken."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(7, long), (None, long), (10, long), (None, "only here, once " * 9), (None, "only here, once " * 9), (None, item), (3, item), (None, None), (4, "")]
    df = spark.createDataFrame([(i, t, "en", None, None, 1, "x") for i, t in rows], DOCS + ", _al_lines int, _al_key string")
    near = corpus_pipeline.drop_near_copies(spark, df, SF)
    assert near.columns == df.columns
    assert sorted([(r.doc_id or 0, (r.text or "")[:5]) for r in near.collect()]) == [(0, "only "), (3, item[:5]), (4, ""), (7, "word0")]
    clean = corpus_pipeline.drop_contaminated(spark, df, SF)
    assert clean.columns == df.columns and clean.count() == 7 and item not in {r.text for r in clean.collect()}
    cut = corpus_pipeline.cut_boilerplate(spark, df, SF)
    assert cut.columns == df.columns and {(r._al_lines, r._al_key) for r in cut.collect()} == {(1, "x")}


def test_pipeline_stages_on_repeated_ids(spark):
    """One row of a group stays, also if its id is in another group; a clean row stays beside a contaminated one of its id."""
    x, y, z = (" ".join(f"{w}{i}" for i in range(300)) for w in ("red", "oak", "sea"))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [(5, x), (7, x.upper()), (3, y), (5, y.upper()), *[(9, z)] * 40, (9, z.upper())]], DOCS).repartition(3)
    near = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
    assert sorted((i, t.lower()) for i, t in near) == [(3, y), (5, x), (9, z)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").orderBy("item_id").first().text
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [(1, item), (1, x), (1, x), (2, y), (2, item)]], DOCS).repartition(3)
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, df, SF).collect()) == [(1, x), (1, x), (2, y)]


def test_toxicity_stage_and_encoding_stage_on_odd_rows(spark, library):
    """Null, empty, repeated and clashing rows: each is judged by its own text, and nothing else of it changes."""
    d = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{d}/documents.parquet")
    marked = source.join(spark.read.parquet(f"{d}/labels.parquet").where("toxic = 1"), "doc_id", "left_semi").limit(3).select("text").collect()
    odd = spark.createDataFrame([(-1, None), (-1, ""), (-1, marked[0].text), (None, None), (None, marked[1].text), (-2, "a calm note"), (-2, "a calm note")], "doc_id bigint, text string")
    whole = source.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd.selectExpr("*", "'en' as lang", "cast(null as string) as source", "0L as n_chars")).withColumns({"score": F.lit("s"), "_al_key": F.lit(1), "y": F.lit(2)})
    left = corpus_pipeline.reject_toxic(spark, whole, d)
    assert left.columns == whole.columns
    got = left.where("doc_id < 0 or doc_id is null").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(-2, "a calm note")] * 2 + [(-1, "")] * 2 + [(0, "")] and {(r.score, r._al_key, r.y) for r in got} == {("s", 1, 2)}
    coded = corpus_pipeline.encode(spark, whole.where("doc_id < 0 or doc_id is null").withColumn("ids", F.lit(0)), d).collect()
    assert sorted(r.ids for r in coded) == sorted(library.encode(r.text or "") for r in odd.collect())


def test_run_leaves_its_result_only(spark, tmp_path):
    """Every folder that the stages wrote is gone, but the last; frames that are kept survive."""
    from almagest.llm import common

    start = len(common._MADE)
    out = corpus_pipeline.run(spark, SF)
    assert [p for p in common._MADE[start:] if common.hadoop(spark, p)[1].exists(common.hadoop(spark, p)[0])] == [out._scratch]
    assert out.count() > 0
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(type("S", (), {"conf": type("C", (), {"get": staticmethod(lambda *a: None)}), "sparkContext": type("X", (), {"master": "spark://h:7077"})}))


def test_pipeline_stages_on_empty_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.count() == 0 and (name == "sentencepiece" or out.columns == df.columns)


def test_lines_keep_clashing_columns(spark):
    df = docs(spark, ["a\nb"] * 30 + [None], extra=True)
    out = line_dedup.drop_boilerplate(df)
    assert out.columns == [*df.columns, "_al_lines", "_al_dropped"]
    assert {(r.text, r._al_host, r._al_lines, r._al_dropped) for r in out.collect()} == {("", "z", 2, 2), (None, "z", 0, 0)}
