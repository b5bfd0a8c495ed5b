import hashlib
import re

from helpers import DATA, empty_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from pulselake.llm import queries
from pulselake.llm.secret_ledger import masked, scan_versions, spans_text

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_whole_table(spark):
    folder = DATA.parent / "sf0.01"
    got = {r.doc_id: r for r in queries.op5_secret_scan(spark, str(folder)).collect()}
    docs = rows_of("documents", folder)
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute(d["text"]), got[d["doc_id"]]
        assert r.spans == want and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k) for k in ("assign", "access", "hex"))
    assert sum(bool(r.spans) for r in got.values()) > 0


TEXTS = [
    "token: secret: abcdefgh",
    "token=secret=abcdefghijk",
    'PASSWORD = "hunter2hunter2" and Api_Key:\'0123456789abcdef0123456789abcdef\'',
    "😀 api-key=nothing apikey==xyz12345 😀 passwd:12345678",
    "AKIAAKIAAKIA AKIAAKIAABCDEFGH12 xAKIA1234567890AB",
    "deadbeef" * 4 + "g" + "0" * 31 + "-" + "1" * 64,
    "tokentoken=aaaaaaaa token=\nbbbbbbbb toKen='c/d+e_f.g-h='",
    "token=" + "a" * 100_000,
]


def test_tricky_texts(spark):
    docs = odd_documents(spark, [(100 + i, t, "en", "s", 0) for i, t in enumerate(TEXTS)])
    found, _ = scan_versions(docs)
    rows = found.select("doc_id", "text", spans_text(F.col("spans")).alias("s"), masked(F.col("text"), F.col("spans")).alias("m")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.s == brute(r.text)
        if r.s:
            assert brute(r.m) == "" and len(r.m) < len(r.text)
        else:
            assert r.m == r.text


def test_ledger_scans_only_what_is_new(spark):
    first = spark.createDataFrame([("a", TEXTS[0]), ("b", TEXTS[1]), ("c", TEXTS[1])], "path string, text string")
    _, gained = scan_versions(first)
    assert gained.count() == 2
    second = spark.createDataFrame([("a", TEXTS[2]), ("b", TEXTS[1]), ("d", TEXTS[1])], "path string, text string")
    found, more = scan_versions(second, gained)
    assert more.count() == 1
    assert {r.path: r.s for r in found.select("path", spans_text(F.col("spans")).alias("s")).collect()} == {
        "a": brute(TEXTS[2]), "b": brute(TEXTS[1]), "d": brute(TEXTS[1]),
    }
    _, again = scan_versions(second, gained.unionByName(more))
    assert again.count() == 0
    _, newer = scan_versions(second, gained.unionByName(more), version="2")
    assert newer.count() == 2


def test_empty(spark):
    found, gained = scan_versions(empty_documents(spark))
    assert found.count() == gained.count() == 0
