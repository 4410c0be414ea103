"""Secret scans: key patterns and sliding-window entropy, as column expressions.

Base kinds are regular expressions (leftmost, non-overlapping per kind):
``assign`` (a named value of 6+ characters), ``access`` (an access key id of
20+) and ``hex`` (24+ lower-case hex digits). The method adds spans of high
entropy: candidate strings are runs of one character class (``entropy_hex``,
``entropy_base64``) with a digit and a letter; a window slides over each, the
counts of its characters and the sum of ``c log2 c`` are updated by the one
character that enters and the one that leaves, and windows whose Shannon
entropy reaches the class's bound are merged into spans. Candidates on the
allow list (slugs of plain words and numbers, UUIDs) are left out, and so are
windows that touch a placeholder. What an earlier kind covers is cut from an
entropy span; what remains is kept if it could be a value by itself: 6+
characters with a digit and a letter that are not on the allow list.

Positions come from ``split`` and ``regexp_extract_all`` on the same pattern,
whose pieces alternate; running sums are kept in blocks, so that many matches
in one text do not cost their square. All spans are code points, end
exclusive. One row is one expression: no shuffle, no Python.

Defined cases: a null text counts as empty (no spans); repeated rows are
scanned each for itself; other columns are ignored by ``scan_documents`` and
passed on by ``redact_documents``, which only changes ``text`` (and
``n_chars``, if there is one) of documents with a span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.frames import fresh, only

# Fixed patterns of the base kinds and their least lengths.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that have 24 or more
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
BASE_KINDS = ("assign", "access", "hex")

WINDOW = 20
# kind, run pattern, alphabet, least entropy of a window (bits)
CLASSES = (
    ("entropy_hex", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])", "0123456789abcdef", 3.0),
    ("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
KINDS = BASE_KINDS + tuple(c[0] for c in CLASSES)
# Words and numbers between separators are allowed: a candidate has a letter
# beside a digit. (No repeated group: Java's matcher recurses once per piece.)
MIXED = r"[A-Za-z][0-9]|[0-9][A-Za-z]"
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",           # UUID
    r"(?i)example|placeholder|0123456789|abcdefgh|(.)\1{7}",             # stand-ins
)
STAND_IN = ALLOWED[-1]  # cut from a candidate; the others concern it as a whole
MASK = "[SECRET]"
_BLOCK = 256
_SPAN = "struct<start:bigint,kind:int,`end`:bigint>"
_NONE = f"array<{_SPAN}>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(a: Column) -> Column:
    """[0, a0, a0+a1, ...]: one more than ``a``."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(a, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _offsets(a: Column) -> Column:
    """The sum of all earlier elements, for each element of a long array."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")),
                         lambda k: _sums(F.slice(a, k * _BLOCK + 1, _BLOCK)))
    return _let(blocks, lambda b: F.flatten(F.zip_with(
        b, F.slice(_sums(F.transform(b, lambda p: F.element_at(p, -1))), 1, F.size(b)),
        lambda p, base: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + base))))


def _span(start, kind: int, end) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"))


def _empty() -> Column:
    return F.array().cast(_NONE)


def _matches(text: Column, pattern: str) -> Column:
    """struct(start, end, m) of each match of ``pattern``, which never
    matches an empty string; an empty array if there is none."""
    def located(found):
        parts = F.split(text, pattern, -1)
        pairs = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, m: F.struct(
            F.length(p).cast("long").alias("p"), F.length(m).cast("long").alias("n"), m.alias("m")))
        return _let(pairs, lambda q: F.zip_with(
            q, _offsets(F.transform(q, lambda x: x["p"] + x["n"])), lambda x, at: F.struct(
                (at + x["p"]).alias("start"), (at + x["p"] + x["n"]).alias("end"), x["m"].alias("m"))))

    none = F.array().cast("array<struct<start:bigint,`end`:bigint,m:string>>")
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
                  ).otherwise(none)


def _between(text: Column, pattern: str) -> Column:
    """struct(start, m) of the pieces between the matches of ``pattern``."""
    def located(found):
        parts = F.split(text, pattern, -1)
        sizes = F.zip_with(parts, found, lambda p, m: (
            F.length(p) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
        return F.zip_with(parts, _offsets(sizes), lambda p, at: F.struct(at.alias("start"), p.alias("m")))

    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), text.alias("m")))
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)
                  ).otherwise(whole)


def _base_spans(text: Column) -> Column:
    def spans(kind, pattern, keep):
        return F.transform(F.filter(_matches(text, pattern), keep),
                           lambda x: _span(x["start"], kind, x["end"]))

    assign = spans(0, ASSIGN, lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_VALUE)
    access = spans(1, ACCESS, lambda x: F.length(x["m"]) >= ACCESS_LENGTH)
    return F.array_sort(F.concat(assign, access, spans(2, HEX, lambda x: F.lit(True))))


def _hot_windows(run: Column, alphabet: str, least: float) -> Column:
    """Merged [start, end) of the windows of ``run`` with enough entropy."""
    c_log_c = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    most = WINDOW * (math.log2(WINDOW) - least)  # entropy >= least: sum of c log2 c at most this
    f = lambda c: F.get(c_log_c, c)
    symbols = F.transform(F.split(run, "", -1), lambda c: F.instr(F.lit(alphabet), c))
    ranges = "array<struct<start:bigint,`end`:bigint>>"
    state = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("count"), F.lit(0.0).alias("s"),
                     F.array().cast(ranges).alias("done"),
                     F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end"))

    def closed(acc):
        return F.when(acc["start"] < 0, acc["done"]).otherwise(F.concat(
            acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))))

    def step(acc, x):
        count, enter, leave = acc["count"], x["enter"], x["leave"]
        n_in, n_out = F.get(count, enter - 1), F.get(count, F.greatest(leave - 1, F.lit(0)))
        s = acc["s"] + F.when(enter == leave, 0.0).otherwise(
            f(n_in + 1) - f(n_in) + F.when(leave > 0, f(n_out - 1) - f(n_out)).otherwise(0.0))
        moved = F.transform(count, lambda c, k: c + (k + 1 == enter).cast("int") - (k + 1 == leave).cast("int"))
        first = (x["i"] - (WINDOW - 1)).cast("long")
        hot = (first >= 0) & (s <= most + 1e-9)
        joins = hot & (acc["start"] >= 0) & (first <= acc["end"])
        opens = hot & ~joins
        return F.struct(moved.alias("count"), s.alias("s"),
                        F.when(opens, closed(acc)).otherwise(acc["done"]).alias("done"),
                        F.when(opens, first).otherwise(acc["start"]).alias("start"),
                        F.when(hot, (x["i"] + 1).cast("long")).otherwise(acc["end"]).alias("end"))

    def slide(sym):
        moves = F.transform(sym, lambda x, i: F.struct(
            x.alias("enter"), F.when(i >= WINDOW, F.get(sym, i - WINDOW)).otherwise(0).alias("leave"),
            i.alias("i")))
        return F.aggregate(moves, state, step, closed)

    return _let(symbols, slide)


def _entropy_spans(text: Column, taken: Column, kind: int) -> Column:
    name, pattern, alphabet, least = CLASSES[kind - len(BASE_KINDS)]
    folded = F.lower if alphabet == alphabet.lower() else lambda c: c

    def wanted(m):
        ok = m.rlike(MIXED)
        for allowed in ALLOWED[:-1]:
            ok = ok & ~m.rlike(allowed)
        return ok

    def hot(run):
        """The hot windows of a run, as spans of the text."""
        pieces = F.filter(_between(run["m"], STAND_IN), lambda p: (F.length(p["m"]) >= WINDOW) & wanted(p["m"]))
        return F.flatten(F.transform(pieces, lambda p: F.transform(
            _hot_windows(folded(p["m"]), alphabet, least),
            lambda h: _span(run["start"] + p["start"] + h["start"], kind, run["start"] + p["start"] + h["end"]))))

    def value(run, x):
        m = F.substring(run["m"], (x["start"] - run["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))
        return (F.length(m) >= ASSIGN_VALUE) & wanted(m)

    def left(run, x, t):
        """What ``t`` leaves of span ``x``."""
        return _let(F.filter(t, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])), lambda over: F.when(
            F.size(over) == 0, F.array(x)).otherwise(F.filter(
                _minus(x, _merged(over), kind), lambda y: value(run, y))))

    found = F.filter(_matches(text, pattern), lambda x: wanted(x["m"]))
    return _let(taken, lambda t: F.flatten(F.transform(found, lambda run: F.flatten(
        F.transform(hot(run), lambda x: left(run, x, t))))))


def _minus(x, cuts: Column, kind: int) -> Column:
    """The pieces of span ``x`` outside disjoint sorted ``cuts``."""
    def pieces(c):
        starts = F.concat(F.array(x["start"]), F.transform(c, lambda y: y["end"]))
        ends = F.concat(F.transform(c, lambda y: y["start"]), F.array(x["end"]))
        return F.filter(F.zip_with(starts, ends, lambda a, b: _span(a, kind, b)), lambda y: y["start"] < y["end"])

    return _let(cuts, pieces)


def _joined(spans: Column, sep: str = ",") -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), sep)


def _with_spans(df: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """Adds array columns of struct(start, kind, end), sorted: base spans and
    all spans. ``text`` must not be null."""
    df = df.withColumn(base, _base_spans(F.col(text)))
    df = df.withColumn(spans, F.col(base))
    for kind in range(len(BASE_KINDS), len(KINDS)):
        df = df.withColumn(spans, F.array_sort(F.concat(
            F.col(spans), _entropy_spans(F.col(text), F.col(spans), kind))))
    return df


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, the digest of
    the base spans, and all spans as text and as an array of structs."""
    d = only(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    d = _with_spans(d, "text", "base", "found")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return d.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        F.col("found"))


def _merged(spans: Column) -> Column:
    """Disjoint [start, end) covering sorted ``spans``."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        here = F.struct(x["start"].alias("start"), x["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return (F.when(F.size(acc) == 0, F.array(here))
                .when(x["start"] <= last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer)))
                .otherwise(F.concat(acc, F.array(here))))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,`end`:bigint>>"), add)


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by ``[SECRET]``; all rows and
    columns stay, ``n_chars`` (if present) follows the new text."""
    text, base, spans, cuts, clean = (fresh(docs, x) for x in ("body", "base", "spans", "cuts", "clean"))
    d = docs.withColumn(text, F.coalesce(F.col("text"), F.lit("")))
    d = _with_spans(d, text, base, spans).withColumn(cuts, _merged(F.col(spans)))
    piece = lambda start, n: F.substring(F.col(text), (start + 1).cast("int"), n.cast("int"))

    def before(x, i):
        left = F.when(i > 0, F.get(F.col(cuts), i - 1)["end"]).otherwise(0)
        return F.concat(piece(left, x["start"] - left), F.lit(MASK))

    tail = F.element_at(F.col(cuts), -1)["end"]
    new = F.concat(F.array_join(F.transform(cuts, before), ""), piece(tail, F.length(text)))
    d = d.withColumn(clean, F.when(F.size(spans) > 0, new).otherwise(F.col("text")))
    own = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.size(spans) > 0, F.length(clean).cast(docs.schema["n_chars"].dataType)
                                ).otherwise(F.col("n_chars"))
    return d.select(*[own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns])
