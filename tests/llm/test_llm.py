"""The operators against plain versions, on texts with every odd case, and on the small tables."""

import importlib
import os
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillage.llm.ann import nearest
from tillage.llm.bpe import PrefixBPE, bpe_decode, bpe_encode
from tillage.llm.components import components
from tillage.llm.decontaminate import common_subsequence, flag_contaminated
from tillage.llm.fm_index import FMIndex
from tillage.llm.line_dedup import line_dedup
from tillage.llm.minhash import near_duplicates
from tillage.llm.queries import QUERIES, tokenizer
from tillage.llm.substring_dedup import substring_dedup
from tillage.llm.suffix_dedup import HashedText, sort_suffixes, suffix_dedup
from tillage.llm.token_files import token_files, write_token_files
from tillage.llm.toxicity import fit_toxicity, score_toxicity, train
from tillage.llm.url_filter import filter_urls

rnd = random.Random(5)
WORDS = ["alpha", "Beta", "gamma,", "délta", "ε", "zeta.", "Eta", "theta", "iota", "kappa"]


def prose(n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(60)) for _ in range(n))


PASSAGE = prose(40)
LINE = "  A common LINE of more than twenty characters\t"
LONG = "\n".join(prose(12) for _ in range(400))
ROWS = [
    (1, None), (2, ""), (3, "   \n\n \t"), (4, "one"), (5, "one two"), (6, LONG), (7, LONG), (8, LONG[:9000] + " odd " + LONG[9000:]),
    (9, f"{prose(30)} {PASSAGE} {prose(9)}"), (10, f"{PASSAGE}\n{LINE}\n{prose(20)}"), (11, f"{LINE}\n{LINE.upper()}\n{PASSAGE[:150]}"), (12, LINE.strip()),
    (13, "Thhaen " * 300), (14, "thhaen " * 90), (15, PASSAGE), (15, PASSAGE), (15, PASSAGE + " more"), (None, PASSAGE + " and " + PASSAGE), (None, LINE),
    (-4, "ünï cödé " * 20), (2**40, "ünï cödé " * 20), (16, "é" * 50), (17, "x" * 5000), *((100 + i, f"{PASSAGE} tail{i} {LINE}") for i in range(30)),
]
SCHEMA = "doc_id long, text string, lang string, __hash string, pos string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "en", "clash", None, None) for d, t in ROWS], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    plain = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("crowded", [1000, 3])
def test_suffix_dedup(docs, nothing, crowded):
    got = suffix_dedup(docs, length=60, crowded=crowded)
    same(got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), brute.repeated_bytes(ROWS, 60))
    for r in got.collect():
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"] and brute.sha(bytes(r["kept"])) == r["kept_sha256"]
    assert suffix_dedup(nothing).count() == 0


def test_suffixes_are_sorted():
    data = np.frombuffer(("abracadabra" * 40 + "abracadabrb").encode(), np.uint8)
    places = np.arange(300)
    order = sort_suffixes(HashedText(data), places, np.zeros(300, np.int64), 100)
    cut = [data[p : p + 100].tobytes() for p in places[order]]
    assert cut == sorted(cut)


@pytest.mark.parametrize("crowded", [1000, 3])
def test_substring_dedup(docs, nothing, crowded):
    got = substring_dedup(docs, window=13, crowded=crowded)
    same(got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), brute.repeated_words(ROWS, 13))
    assert substring_dedup(nothing).count() == 0


def test_fm_index():
    numbers = np.random.default_rng(1).integers(1, 5, 500)
    numbers[-1] = 0
    index = FMIndex(numbers, 6)
    text = numbers.tolist()
    for _ in range(200):
        pattern = [rnd.randrange(1, 5) for _ in range(6)]
        length, begin, end = (int(x[0]) for x in index.search(np.array([pattern])))
        fits = [n for n in range(7) if any(text[i : i + n] == pattern[6 - n :] for i in range(500 - n + 1))]
        assert length == max(fits)
        assert end - begin == sum(text[i : i + length] == pattern[6 - length :] for i in range(500 - length + 1)) or length == 0


def test_line_dedup(docs, nothing):
    got = line_dedup(docs)
    assert set(docs.columns) <= set(got.columns)
    same(got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect(), brute.lines(ROWS))
    assert line_dedup(nothing).count() == 0


@pytest.mark.parametrize("percent,shingle", [(85, 3), (80, 5), (50, 2)])
def test_near_duplicates(docs, nothing, percent, shingle):
    same(near_duplicates(docs, percent, shingle).collect(), brute.near(ROWS, percent, shingle))
    assert near_duplicates(nothing).count() == 0


def test_near_duplicates_that_only_a_chain_or_an_outsider_links(spark):
    base = prose(120).split()
    rows = [(1, " ".join(base))]
    for i in range(60):  # copies with changes of their own: linked to the first, not to each other
        w = base[:]
        for _ in range(3):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
        rows.append((2 + i, " ".join(w)))
    for i in range(40):  # a chain
        rows.append((200 + i, " ".join(f"c{j}" for j in range(i * 3, i * 3 + 80))))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85, 3)
    same(got.collect(), brute.near(rows, 85, 3))


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 301), (301, 300)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(80)}, 300: 300, 301: 300}


def test_an_encoder_is_built_in_little_memory():
    import tracemalloc

    import public_tokenizers

    tracemalloc.start()
    try:
        PrefixBPE(public_tokenizers.path("word_bpe_49k.json"))
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < held + (64 << 20)


def test_toxicity(spark, docs, nothing):
    bad = ["blorkhead", "snarfle", "grumptwit"]
    texts = [prose(30) for _ in range(400)]
    y = [i % 4 == 0 for i in range(400)]
    texts = [t + " " + rnd.choice(bad) + " " + prose(5) if b else t for t, b in zip(texts, y)]
    model = train(texts, [int(b) for b in y])
    got = model.score([prose(20), "you BLORKHEAD!", "bl-ork-head", "s n a r f l e", "snarxfle", "", "so a grumptwits"])
    assert [s >= 0.3 for s in got] == [False, True, True, True, True, False, True]
    scored = score_toxicity(docs, model)
    assert scored.count() == len(ROWS) and scored.columns == [*docs.columns, "score"]
    assert [r["score"] for r in scored.where("text is null or text = ''").collect()] == [0, 0]
    assert score_toxicity(nothing, None).count() == 0
    assert train([], []) is None and score_toxicity(docs, None).where("score <> 0").count() == 0


def test_toxicity_is_learnt_in_a_task(spark, monkeypatch):
    """The driver neither collects the texts nor trains on them."""
    rows = [(i, f"word{i} plain text zzbad" if i % 2 else f"word{i} plain text here", i % 2) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    here, driver = train([t for _, t, _ in rows], [y for _, _, y in rows]), os.getpid()
    monkeypatch.setattr("tillage.llm.toxicity.train", lambda *a: pytest.fail("trained on the driver") if os.getpid() == driver else train(*a))
    model = fit_toxicity(docs, labels)
    texts = [t for _, t, _ in rows] + ["", "zzzbad"]
    assert model.score(texts) == here.score(texts) and model.score(["zzbad"])[0] > 0.3
    assert fit_toxicity(docs, labels.limit(0)) is None


def test_toxicity_on_held_out_rows(spark, sf_dir):
    small = sf_dir.replace("sf0.001", "sf0.1")
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, small).collect()}
    labels = spark.read.parquet(f"{small}/labels.parquet").collect()
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in labels)


def test_decontamination(spark, docs, nothing):
    items = [(i, ". ".join(" ".join(f"w{i}x{rnd.randrange(900)}" for _ in range(9)) for _ in range(4)) + ".") for i in range(12)]
    copy = items[3][1]
    bent = items[5][1].split()
    for i in range(0, len(bent), 5):
        bent[i] = "other"
    rows = [(1, f"{prose(60)} {copy} {prose(50)}", None), (2, f"{prose(33)}\n{' '.join(bent)} {prose(9)}", None), (3, prose(400), None), (4, None, 1), (5, "", 2),
            (6, copy.upper(), 3), (6, copy.upper(), 3), (7, " ".join(copy.split()[:7]) + " " + prose(80), 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, overlap int")
    bench = spark.createDataFrame([*items, (77, None), (78, ""), (None, copy)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in flag_contaminated(table, bench).collect())
    assert got == [(1, 3), (2, 5), (3, None), (4, None), (5, None), (6, 3), (6, 3), (7, None)]
    assert flag_contaminated(table, bench.limit(0)).where("contaminated").count() == 0
    assert flag_contaminated(nothing, bench).count() == 0
    assert common_subsequence(list("abcbdab"), list("bdcaba")) == 4 and common_subsequence([], [1]) == 0


def test_every_exact_leak_is_found(spark, sf_dir):
    small = sf_dir.replace("sf0.001", "sf0.01")
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    leaks = {r["doc_id"] for r in texts if any(i in r["text"] for i in items)}
    got = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, small).collect()}
    assert leaks <= got and len(got - leaks) <= 2


def test_leaks_beyond_the_latent_rank(spark):
    # far more passages than the space has directions, and none like another
    items = [(i, " ".join(f"r{i}y{j}" for j in range(24))) for i in range(1000)]
    rows = [(i, f"{prose(40)} {items[i][1]} {prose(40)}") for i in range(0, 1000, 10)] + [(5000 + i, prose(120)) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = flag_contaminated(table, spark.createDataFrame(items, "item_id long, text string")).where("contaminated").collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(0, 1000, 10)]


def test_short_items(spark):
    items, rows = [], []
    for i, n in enumerate(n for n in range(5, 21) for _ in range(3)):
        words = [f"s{i}z{j}" for j in range(n)]
        items.append((i, " ".join(words)))
        bent = ["other" if n >= 8 and j % 4 == 1 else w for j, w in enumerate(words)]
        for doc, some in ((i, words), (100 + i, bent)):
            rows.append((doc, f"{' '.join(f'd{doc}q{j}' for j in range(50 + i))} {' '.join(some)} {' '.join(f'e{doc}q{j}' for j in range(50))}"))
    table = spark.createDataFrame([*rows, (900, prose(300))], "doc_id long, text string")
    got = flag_contaminated(table, spark.createDataFrame(items, "item_id long, text string")).where("contaminated").collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((d, d % 100) for d, _ in rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest(spark, kind):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, rows[100][1]) for i in range(50)]
    rows += [(700, None), (800, [0.0] * 8), (900, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8), (1100, [float("inf")] * 8), (1200, [1.0]), (None, [1.0] * 8)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("entry", F.lit("clash")).withColumn("vector", F.lit(1))
    got = sorted(tuple(r) for r in nearest(table).collect())
    want = sorted(brute.nearest(rows, 10, 100))
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12, atol=0)
    assert nearest(table.limit(0)).count() == 0


def test_recall(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    points = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    found = {}
    for r in QUERIES["op6_ann"](spark, folder).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((points - points[q]) ** 2).sum(1))
        far[q] = np.inf
        hits.append(len(set(ids[np.lexsort((ids, far))[:10]].tolist()) & found[ids[q]]) / 10)
    assert np.mean(hits) >= 0.9


def test_recall_is_measured(spark):
    # 2 trees: the fixed width finds few of the neighbours
    points = np.random.default_rng(4).standard_normal((6000, 32))
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest(table, trees=2).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in range(0, 6000, 100):
        far = ((points - points[q]) ** 2).sum(1)
        far[q] = np.inf
        hits.append(len(set(np.argsort(far)[:10].tolist()) & found[q]) / 10)
    assert np.mean(hits) >= 0.9


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net", "http://net/a", "http://xnet/a", "https://a.b.example.com/de/", "https://example.com/DE/",
            "http://org/fr/", "http://x.org/fr", "http://u@example.net:80/en/", "http://a.net?/en/", "ftp://é.NET/://x", "http://example.net./en/", "http://a..net/x", "x://y://example.net/en/", "http://example.net/en/"]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/", "block")]

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = next((rest[:i] for i, c in enumerate(rest) if c in "/?#"), rest)
        path = rest[len(host) :].split("#")[0].split("?")[0] if rest[len(host) :][:1] == "/" else ""
        host = host.translate(brute.LOW)
        fit = [(len(h + p), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(3, urls[4], "again")] + [(50 + i, f"http://hot.example.net/en/{i}", "") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    same(filter_urls(pages, table).collect(), [(i, *judge(u)) for i, u, _ in rows])
    assert filter_urls(pages.limit(0), table).count() == 0
    assert {r["verdict"] for r in filter_urls(pages, table.limit(0)).collect()} == {"allow"}


def odd_texts():
    pool = [32, 32, 46, 10, 9, 13, 28, 0x3A3, 0x130, 0xE9, 0x301, 0x3000, 0x4E2D, 0x1F600, 39, *range(97, 110), *range(48, 52), *range(33, 48)]
    made = ["".join(chr(rnd.choice(pool)) for _ in range(rnd.randrange(80))) for _ in range(150)]
    return [None, "", " ", "I'LL don't 's", "<|endoftext|>x <|startoftext|>", "ΑΣ ΣΑΣ", "a\x00b \x01", "!\x1c a", LONG, "q" * 3000, *made, *[t for _, t in ROWS]]


def test_bpe(spark, nothing):
    from tokenizers import Tokenizer

    file = tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(file)
    rows = list(enumerate(odd_texts()))
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    encoded = bpe_encode(table, file).cache()
    decoded = {r["doc_id"]: r["decoded"] for r in bpe_decode(encoded, file).collect()}
    got = {r["doc_id"]: r for r in encoded.collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        want = t.encode(text or "", add_special_tokens=False).ids
        assert got[d]["ids"] == want and got[d]["n_tokens"] == len(want)
        assert got[d]["decoded"] == decoded[d] == t.decode(want, skip_special_tokens=False)
    assert bpe_encode(nothing, file).count() == 0


def test_bpe_words_of_any_letters():
    from tokenizers import Tokenizer

    file = tokenizer("word_bpe_49k.json")
    t, mine = Tokenizer.from_file(file), PrefixBPE(file)
    for _ in range(3000):
        word = "".join(rnd.choice("aabcdeeghilnorstty") for _ in range(rnd.randrange(1, 24)))
        assert mine.word(word) == t.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("length,rows_", [(64, 4), (2048, 64)])
def test_token_files(spark, nothing, tmp_path, length, rows_):
    from tokenizers import Tokenizer

    file = tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(file)
    rows = [*enumerate(odd_texts()), (None, "no id")]
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("path", F.lit("clash"))
    got = token_files(table, file, str(tmp_path / "a"), length=length, rows=rows_).collect()
    want, at = [], 0
    for d, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    same(got, want)
    assert write_token_files(nothing, file, str(tmp_path / "b")).count() == 0


def test_pipeline(spark, sf_dir):
    """Each stage on its own input against plain versions, and the stages together."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    held = docs
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in held.collect()}
        after = spark.createDataFrame((df := stage(spark, held, sf_dir)).collect(), df.schema).cache()
        rows = sorted(before.items())
        if name == "line dedup":
            want = {d: h for d, _, _, h in brute.lines(rows)}
            assert {r["doc_id"]: brute.sha(r["text"]) for r in after.collect()} == want
        elif name == "near-duplicates":
            assert {r["doc_id"] for r in after.collect()} == {d for d, _, _, kept in brute.near(rows, 80, 5) if kept}
        elif name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            clean = {d for d, t in rows if not any(i in t for i in items)}
            assert {r["doc_id"] for r in after.collect()} <= clean and after.count() >= len(clean) - 2
        elif name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
            assert not toxic & {r["doc_id"] for r in after.collect()} or len(rows) < 500
        if name != "bpe":
            assert after.columns == columns
        held = after
    same(pipeline.run(spark, sf_dir).collect(), held.collect())


def test_near_duplicates_with_a_common_passage(spark):
    """Texts that are mostly one passage and yet not alike do not meet; those that are alike do."""
    passage = [f"p{i}" for i in range(90)]
    rows = []
    for i in range(600):
        n = 17 + i % 5
        rows.append((i, " ".join(passage + [f"u{i}x{j}" for j in range(n)])))
    rows += [(1000 + i, " ".join([f"v{i}y{j}" for j in range(i % 4)] + passage + [f"w{i // 2}" * (i % 3 == 0)])) for i in range(60)]
    rows += [(2000 + i, rows[i][1] + " more") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(near_duplicates(table, percent=85, shingle=3).collect(), brute.near(rows, 85, 3))


def test_memo_is_bounded_by_bytes():
    from tillage.llm.common import TwoAges, hold

    memo = TwoAges(10_000, "one")
    for i in range(3000):
        for k in memo.missing({f"k{i}"}):
            memo[k] = (b"x" * 50, "y")
        memo.turn()
        assert len(memo) + len(memo.old) < 150
    hold("one")
    assert memo or memo.old
    hold("two")
    assert not memo and not memo.old


def test_one_row_stays_of_each_group(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (1, "other text of the same id here"), (3, None), (3, None), (None, "a b c d e f g"), (4, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(table, rows=True).collect()
    same(((r.doc_id, r.n_shingles, r.first) for r in got), [(1, 3, True), (1, 3, True), (2, 3, False), (1, 3, True), (3, 0, True), (3, 0, True), (None, 3, True), (4, 0, True)])
