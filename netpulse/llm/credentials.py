"""Secret scans: base spans by pattern, and weak parts of credentials where complementary parts co-occur."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import stored, with_row_key


def _any_case(words: str) -> str:
    """Each ASCII letter as a class of its two cases; engines differ in what else they fold."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Base patterns. A match of ASSIGN whose value is shorter than LEAST_ASSIGNED is dropped after it was found.
ASSIGN = "(" + _any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LEAST_ASSIGNED = 8

#: Weak parts of a credential: who logs in, what proves it, and where.
_GIVEN = r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{3,}"""
LOGIN = "(" + _any_case("username|user_?id|user|login|account|client_?id|access_?key_?id") + ")" + _GIVEN
PROOF = "(" + _any_case("pwd|passphrase|passcode|pass|private_?key|access_?key|auth|credentials?|signature") + ")" + _GIVEN
PLACE = (
    "((" + _any_case("https?|ftps?|sftp|ssh|jdbc|postgres|postgresql|mysql|mongodb|redis|amqps?|ldaps?")
    + ")://[A-Za-z0-9._~%:@/?&=+-]{3,}|(" + _any_case("hostname|host|server|endpoint") + ")" + _GIVEN + ")"
)

#: Kinds in the order in which spans of one start are listed: the base kinds, then the weak ones.
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "login": LOGIN, "proof": PROOF, "place": PLACE}
KINDS = list(PATTERNS)
BASE = ("assign", "access", "hex")
#: Each match has one of these in it, lower-cased; a text without any is not searched for the kind.
LITERALS = {
    "assign": ("password", "passwd", "secret", "token", "api"),
    "access": ("akia",),
    "login": ("user", "login", "account", "client", "access"),
    "proof": ("pwd", "pass", "private", "access", "auth", "credential", "signature"),
    "place": ("://", "host", "server", "endpoint"),
}
#: The part of a credential that a kind is; base kinds are strong.
PARTS = {"who": ("access", "login"), "what": ("assign", "hex", "proof"), "where": ("place",)}
WEAK_PARTS = {"login": "who", "proof": "what", "place": "where"}

#: A scope: parts begin at most so many code points apart, with no empty line between them.
REACH = 200
BLOCK_END = r"\n[\x20\t\r]*\n"

#: Running places are summed up in pieces of so many matches.
PIECE = 256

_SPAN = "array<struct<start:bigint,end:bigint,match:string>>"


def may_hold(lowered: Column, kind: str) -> Column:
    """Whether a lower-cased text has a literal of the kind: a byte search, much cheaper than the pattern."""
    found = F.lit(kind not in LITERALS)
    for literal in LITERALS.get(kind, ()):
        found = found | lowered.contains(literal)
    return found


def spans(text: Column, pattern: str, worth: Column | None = None) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches, in code points.

    Splitting at the pattern leaves the text between the matches, so running lengths give the
    places. They are summed within pieces, whose own starts are summed before: appending to one
    long array would copy it for every match. Only texts that have a match are split; those that are
    not ``worth`` it are not searched.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("match"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"))
    held = text.rlike(pattern) if worth is None else worth & text.rlike(pattern)
    return F.when(held, _placed(pairs)).otherwise(F.array().cast(_SPAN))


def _placed(pairs: Column) -> Column:
    def length(pair: Column) -> Column:
        return (F.char_length(pair["gap"]) + F.char_length(pair["match"])).cast("bigint")

    def piece(number: Column) -> Column:
        return F.slice(pairs, number * PIECE + 1, F.lit(PIECE))

    def begun(state: Column, size: Column) -> Column:
        return F.struct((state["at"] + size).alias("at"), F.array_append(state["starts"], state["at"]).alias("starts"))

    def placed(state: Column, pair: Column) -> Column:
        end = state["at"] + length(pair)
        one = F.struct((end - F.char_length(pair["match"])).alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], one).alias("spans"))

    zero = F.lit(0).cast("bigint")
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(pairs) / PIECE).cast("int") - 1, F.lit(0)))
    sizes = F.transform(numbers, lambda n: F.aggregate(piece(n), zero, lambda total, pair: total + length(pair)))
    starts = F.aggregate(
        sizes, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts")), begun, lambda s: s["starts"]
    )
    return F.flatten(
        F.transform(
            F.arrays_zip(numbers.alias("n"), starts.alias("at")),
            lambda p: F.aggregate(
                piece(p["n"]), F.struct(p["at"].alias("at"), F.array().cast(_SPAN).alias("spans")), placed, lambda s: s["spans"]
            ),
        )
    )


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, _key_id, _key_text and arrays: base, weak as (start, kind number, end), blocks as (start, end, match).

    One pass over the texts, without a shuffle. ``blocks`` says where blocks of lines end, for texts
    with a weak part.
    """
    text, lowered = F.col("text"), F.col("lowered")

    def of_kind(kind: str) -> Column:
        found = spans(text, PATTERNS[kind], may_hold(lowered, kind))
        if kind == "assign":
            value = lambda s: F.regexp_extract(s["match"], f"^{ASSIGN}$", 2)
            found = F.filter(found, lambda s: F.char_length(value(s)) >= LEAST_ASSIGNED)
        number = F.lit(KINDS.index(kind))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end")))

    weak = [of_kind(kind) for kind in WEAK_PARTS]
    keyed = with_row_key(docs.select(F.col("doc_id").cast("bigint"), "text")).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    found = keyed.withColumn("lowered", F.lower("text")).select(
        "doc_id", "_key_id", "_key_text",
        F.concat(*[of_kind(kind) for kind in BASE]).alias("base"),
        F.concat(*weak).alias("weak"), "text",
    )
    blocks = F.when(F.size("weak") > 0, spans(F.col("text"), BLOCK_END)).otherwise(F.array().cast(_SPAN))
    return found.withColumn("blocks", blocks).drop("text")


_KEY = ["_key_id", "_key_text"]


def linked(found: DataFrame) -> DataFrame:
    """``(_key_id, _key_text, added)``: weak parts that belong to a credential, from :func:`scanned` rows.

    A login or a proof is reported if its counterpart is in the same scope and is strong, or if a
    place is in the scope of both ends too; a place if a who and a what are. The interval join runs over
    bins as wide as the reach: for every part, the bins of a block keep only the first and the last
    start, since those tell whether any lies within reach. So a candidate meets three rows, however
    many parts stand around it. Documents without a weak part do not enter; repeated rows enter once.
    """
    number = F.lit(-1)
    ends = F.transform("blocks", lambda b: F.struct(b["end"].alias("start"), number.alias("kind"), b["end"].alias("end")))
    rows = (
        found.where(F.size("weak") > 0)
        .dropDuplicates(_KEY)
        .select(*_KEY, F.explode(F.concat("base", "weak", ends)).alias("s"))
        .select(*_KEY, "s.start", "s.kind", "s.end")
    )
    # how many blocks ended at or before a part's start
    block = F.expr(
        "count_if(kind = -1) OVER (PARTITION BY _key_id, _key_text ORDER BY start, kind ROWS UNBOUNDED PRECEDING)"
    )
    parts = stored(
        rows.withColumns({"block": block, "bin": F.floor(F.col("start") / REACH)}).where("kind >= 0"), "credential-parts"
    )

    def of(kinds: tuple[str, ...]) -> Column:
        return F.when(F.col("kind").isin(*[KINDS.index(k) for k in kinds]), F.col("start"))

    groups = {part: kinds for part, kinds in PARTS.items()}
    groups |= {f"{part}_strong": tuple(k for k in kinds if k in BASE) for part, kinds in PARTS.items() if part != "where"}
    bins = parts.groupBy(*_KEY, "block", "bin").agg(
        *[f(of(kinds)).alias(f"{name}_{end}") for name, kinds in groups.items() for end, f in (("first", F.min), ("last", F.max))]
    )
    weak = parts.where(F.col("kind").isin(*[KINDS.index(k) for k in WEAK_PARTS]))
    probes = weak.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("bin", F.col("bin") + F.col("step"))
    met = probes.join(bins, [*_KEY, "block", "bin"])

    def within(name: str) -> Column:
        before = (F.col("step") == -1) & (F.col("start") - F.col(f"{name}_last") <= REACH)
        after = (F.col("step") == 1) & (F.col(f"{name}_first") - F.col("start") <= REACH)
        return F.coalesce(F.bool_or(before | after | ((F.col("step") == 0) & F.col(f"{name}_first").isNotNull())), F.lit(False))

    near = met.groupBy(*_KEY, "start", "kind", "end").agg(*[within(name).alias(name) for name in groups])
    login, proof, place = (F.col("kind") == KINDS.index(k) for k in WEAK_PARTS)
    complete = (
        (login & F.col("what") & (F.col("what_strong") | F.col("where")))
        | (proof & F.col("who") & (F.col("who_strong") | F.col("where")))
        | (place & F.col("who") & F.col("what"))
    )
    return near.where(complete).groupBy(*_KEY).agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of (start, kind, end) by start and kind, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(found), text), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, base and added (arrays) of every row.

    Only ``doc_id`` and ``text`` are read, other columns may have any name. A null text is empty; rows
    with null or equal ids keep their own results; repeated rows have equal ones. Whole texts of any
    length are scanned. An empty table gives no rows.
    """
    found = stored(scanned(docs), "credential-spans")
    joined = found.join(linked(found), _KEY, "left")
    added = F.coalesce("added", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    counts = {f"n_{kind}": F.size(F.filter("base", _is(kind))).cast("bigint") for kind in BASE}
    return joined.select(
        "doc_id", *[count.alias(name) for name, count in counts.items()],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", added)).alias("spans"),
        "base", added.alias("added"),
    )


def _is(kind: str):
    return lambda s: s["kind"] == KINDS.index(kind)
