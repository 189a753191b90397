"""Spelling variants, WARC archives and conversation repair against plain versions."""

import io
import random

import brute
import pytest
from pyspark.sql import functions as F

from tillage.llm.conversation_repair import Tables, damage, repair_conversations
from tillage.llm.queries import QUERIES
from tillage.llm.spelling import spelling_variants
from tillage.llm.warc import assemble_captures, list_warc, parse_records, read_warc, warc_captures, write_warc


def rows_of(found):
    return sorted((tuple(r) for r in found), key=repr)


def words_fixture():
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(4, 9))) for _ in range(60)]

    def variant(w):
        i = rnd.randrange(len(w))
        return rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abÀ×xyz") + w[i + 1 :], w[:i] + rnd.choice("abÿ") + w[i:], w, w.upper()])

    docs = [(None if i % 50 == 0 else i, " ".join(variant(rnd.choice(base)) for _ in range(60)) + rnd.choice(["", " x1y", "\n", "_"])) for i in range(300)]
    return docs + [(5, None), (6, ""), (7, "x" * 3000), (7, "x" * 3000), (7, "x" * 3000 + " " + "x" * 3001 + " " + "x" * 3001 + "." + "x" * 3001), (8, "日本 abcde\u0301 1234")]


@pytest.mark.parametrize("crowd", [32, 2])
def test_spelling_variants(spark, crowd):
    docs = words_fixture()
    table = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    assert rows_of(spelling_variants(table, crowd=crowd).collect()) == rows_of(brute.spelling(docs))


def test_spelling_empty(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(table).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(table, ratio=1)


BIG = "<p>é WARC/1.1\r\n\r\nContent-Length: 5\r\n</p>" * 20
PAGES = [
    (1, "http://a.b/c?d#e", None), (2, None, ""), (3, "ü:// x\r\ny", BIG), (4, "http://a", BIG), (3, "http://b", BIG), (3, "http://b", BIG), (None, "x://y", BIG),
    (None, None, "z" * 2_000_000), (9, "k", "z" * 2_000_000), (10, "q", "s" * 99), (11, "q", "s" * 99), (12, "q", "s" * 100), (12, "q", "s" * 100), (13, "q", "s" * 100),
    *((100 + i, f"http://h{i}/", BIG + "x" * (i % 3)) for i in range(50)), *[(500, "r", "same" * 50)] * 5000,
]


def test_warc_round_trip(spark):
    table = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(4)
    out = warc_captures(table, bodies=True, file_bytes=20_000)
    want = [(p, n, d, k, r) for p, _, n, d, k, r in brute.warc(PAGES)]
    assert rows_of(out.drop("capture").collect()) == rows_of(want)
    some = out.where("page_id < 100").select("record_type", "payload_digest", "capture").collect()
    for r in some:
        assert len(r.capture.requests) == 1 and r.capture.requests[0].http.startswith("GET ")
        if r.record_type == "response":
            assert r.capture.intact and brute.sha(bytes(r.capture.payload)) == r.payload_digest
        else:
            assert r.capture.payload is None and r.capture.refers_to


def test_warc_empty_and_foreign(spark, tmp_path):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_captures(table).count() == 0
    # a plain file whose links run from the response, and through the request
    def rec(kind, name, extra, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <{name}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"

    text = rec("request", "q", "", "GET") + rec("response", "r", "WARC-Concurrent-To: <q>\r\nX-Long: a\r\n b\r\n", "body") + rec("metadata", "m", "WARC-Concurrent-To: <q>\r\nContent-Type: application/warc-fields\r\n", "k: v\r\n") + rec("metadata", "lost", "", "")
    (tmp_path / "x.warc").write_bytes(text.encode())
    (tmp_path / "other.txt").write_text("no")
    got = assemble_captures(read_warc(list_warc(spark, str(tmp_path)))).collect()
    assert [(r.record_id, bytes(r.payload), [q.record_id for q in r.requests], r.metadata) for r in got] == [("r", b"body", ["q"], [{"k": "v"}])]
    with pytest.raises(ValueError):
        list(parse_records(io.BytesIO(text.encode()[:-40])))
    with pytest.raises(ValueError):
        list(parse_records(io.BytesIO(b"HTTP/1.1 200\r\n")))


def test_warc_repeated_write(spark, tmp_path):
    table = spark.createDataFrame(PAGES[:9], "page_id long, url string, html string")
    first, second = (read_warc(write_warc(table, str(tmp_path / x)), bodies=False).drop("path").where("kind <> 'warcinfo'") for x in "ab")
    assert rows_of(first.collect()) == rows_of(second.collect())


def talks():
    rnd = random.Random(3)
    rows = []
    for c in range(300):
        for t in range(rnd.randrange(0, 12)):
            turn = rnd.choice([t, t + rnd.randrange(3), None]) if c % 7 == 0 else t
            role = rnd.choice(["user", "assistant", "system", "tool", "", None]) if c % 3 == 0 else ["user", "assistant"][t % 2]
            rows.append((c if c else None, turn, role, rnd.choice([None, "", "Hi.", "Well", "Why?", "  \n", f"A {t}.", f"B {t} ", f"C{t}!"])))
    rows += [(5000, t, rnd.choice(["user", "assistant"]), rnd.choice([f"x{t % 70}.", "y", f"z{t}"])) for t in range(200)]
    return rows + [(6000, 1, "user", "same.")] * 300 + [(6001, 2**40, "user", "long " * 50_000 + "."), (6001, 2**40 + 1, "assistant", "x" * 6_000_000)]


@pytest.mark.parametrize("partitions", [3, 40])
def test_conversation_repair(spark, partitions):
    rows = talks()
    texts = sorted({x for _, _, _, x in brute.damaged(rows) if x is not None})
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, cost string").repartition(5)
    code = {r.t: r.h for r in spark.createDataFrame([(x,) for x in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    want = brute.repaired(brute.damaged(rows), lambda y: (y[1], code[y[2]], y[2]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = repair_conversations(damage(table)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows_of(r[:8] + r[9:] for r in map(tuple, got)) == rows_of(want)
    assert all(brute.sha(r.repaired) == r.repaired_sha256 for r in got)


def test_conversation_repair_empty(spark):
    assert repair_conversations(damage(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_block_tables_equal_single_steps():
    made, rnd = Tables(), random.Random(1)
    for _ in range(200):
        symbols = bytes(rnd.randrange(9) for _ in range(rnd.randrange(0, 14)))
        to, cost = made.through(symbols)
        for v in range(len(made.vectors)):
            at, paid = v, 0
            for s in symbols[::-1]:
                at, paid = made.step_to[at][s], paid + made.step_cost[at][s]
            assert (to[v], cost[v]) == (at, paid)


def test_whole_small_tables(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_spelling"](spark, sf_dir).collect()) == rows_of(brute.spelling(docs))
    pages = [tuple(r) for r in read("pages").select("page_id", "url", "html").collect()]
    assert rows_of(QUERIES["op12_warc"](spark, sf_dir).collect()) == rows_of((p, n, d, k, r) for p, _, n, d, k, r in brute.warc(pages))
    talk = [tuple(r) for r in read("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op13_conversation_repair"](spark, sf_dir).collect()) == rows_of(brute.repaired(brute.damaged(talk), lambda y: y))
