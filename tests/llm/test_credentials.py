"""Secret scans: base spans against a plain regular expression search, linking against a loop over all parts, SQL."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

from netpulse.llm import credentials as C
from netpulse.llm import queries
from verification.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


def plain_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = {"assign": [m.span() for m in assign.finditer(text) if len(m[2]) >= 8]}
    found["access"] = [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found["hex"] = [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    for kind in C.WEAK_PARTS:
        found[kind] = [m.span() for m in re.finditer(C.PATTERNS[kind], text)]
    return found


def plain_links(text: str | None) -> list[tuple[int, int, int]]:
    found = plain_spans(text)
    ends = [m.end() for m in re.finditer(C.BLOCK_END, text or "")]
    parts = [(s, kind, e, sum(end <= s for end in ends)) for kind, spans in found.items() for s, e in spans]
    out = []
    for start, kind, end, block in parts:
        near = {k for s, k, _, b in parts if b == block and abs(s - start) <= C.REACH}
        who, what, where = (near & set(C.PARTS[p]) for p in ("who", "what", "where"))
        if (
            (kind == "login" and what and (what & set(C.BASE) or where))
            or (kind == "proof" and who and (who & set(C.BASE) or where))
            or (kind == "place" and who and what)
        ):
            out.append((start, C.KINDS.index(kind), end))
    return out


def plain_row(doc_id, text) -> tuple:
    found = plain_spans(text)
    base = sorted((s, C.KINDS.index(kind), e) for kind in C.BASE for s, e in found[kind])
    told = lambda spans: ",".join(f"{C.KINDS[k]}:{s}:{e}" for s, k, e in spans)
    digest = hashlib.sha256(told(base).encode()).hexdigest()
    return (doc_id, *(len(found[kind]) for kind in C.BASE), digest, told(sorted(base + plain_links(text))))


def result(df) -> list[tuple]:
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def by_plain_loops(rows) -> list[tuple]:
    return sorted((plain_row(*row) for row in rows), key=repr)


AKIA, HEX = "AKIA" + "ABCDEFGH01234567", "0123456789abcdef" * 2
TEXTS = [
    f"user = bob, {AKIA} and secret: {HEX}",
    "login: ann\npass = s3cr\nhost: db.example.org",  # all weak, linked by the place
    "login: ann\npass = s3cr",  # no place: nothing to report
    "login: ann\n\npass = s3cr\nhost: db.example.org",  # another block
    "user: ann " + "x" * 185 + " PWD=abcd https://example.org/x",  # within reach
    "user: ann " + "x" * 186 + "     PWD=abcd https://example.org/x",  # beyond it
    f"{AKIA} " + "y" * 390 + " passcode=1234" + "z" * 180 + f" {AKIA}",
    'token="secret" : "abcdefghij"',  # the short match uses up the second key
    "Token == abcdefgh tokentoken=abcdefg api-key=abcdefghi API_KEY:'abcdefgh' apiKey=abcdefghK",
    "Kasswd=abcdefgh paſſword=abcdefgh password=éabcdefgh",  # letters that fold elsewhere
    "\U0001f600é " + f"token={HEX}é{HEX[:31]} {HEX}g{HEX}",
    "AKIA AKIAAKIAAKIAAKIA AKIA0123456789 AKIA012345678901_AKIA",
    "user=a1b2 pass=c3d4 " * 600 + "server: x.y.z",  # many parts in a row
    f"token={HEX}\n" * 700,  # more matches than a piece
    "user=bob pass=abcd the ssh and http words",  # no place
    "user=bob pass=abcd at SSH://box.example",
    "host=h1x user=u1x auth=p1x\n \t\nhost=h2x user=u2x\n\nauth=p3x host=h3x",
]


@pytest.fixture(scope="module")
def planted(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[0]), (0, TEXTS[0]), (None, TEXTS[1]), (None, TEXTS[2])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query_against_a_plain_search(spark, tables):
    rows = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    assert result(C.secrets(tables("documents"))) == by_plain_loops(rows)


def test_planted_parts(planted):
    rows = [tuple(r) for r in planted.collect()]
    got = result(C.secrets(planted))
    assert got == by_plain_loops(rows)
    spans = {r[0]: r[-1] for r in got if r[0] not in (0, 3)}
    assert "login" in spans[1] and "place" in spans[1] and spans[2] == ""
    of = {text: found for text, found in zip(TEXTS, (plain_row(0, t)[-1] for t in TEXTS))}
    assert of["user=bob pass=abcd the ssh and http words"] == ""
    assert of["user=bob pass=abcd at SSH://box.example"] == "login:0:8,proof:9:18,place:22:39"
    assert "proof" in spans[4] and "proof" not in spans[5]


def test_sql_of_planted_parts(planted, folder):
    where = folder("documents", planted)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{where}/documents.parquet/*.parquet')")
    assert differences(C.secrets(planted).drop("base", "added"), con, queries.ORACLES["op12_secrets"]) == []


def test_query_against_sql(spark):
    assert differences(queries.op12_secrets(spark, SMALL), connect(SMALL), queries.ORACLES["op12_secrets"]) == []


def test_odd_rows(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert result(C.secrets(odd)) == by_plain_loops(rows)


def test_empty_table(spark):
    assert C.secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(planted):
    from netpulse.llm.credentials import linked, scanned

    plan = linked(scanned(planted))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
