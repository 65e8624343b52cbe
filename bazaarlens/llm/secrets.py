"""Secret scan with multipart credential linking (operator 1), DataFrame only.

Every part of a credential found in a whole text is a span (kind, start, end)
in code points. Strong kinds are reported wherever they stand; weak kinds only
when a complementary part stands within ``reach`` code points of them:

==========  ==========  ======  =================================================
kind        role        class   found
==========  ==========  ======  =================================================
assign      secret      strong  ``password = value`` and the like, value of 6+
access      identifier  strong  ``AKIA`` and capitals or digits, 20+
hex         secret      strong  lower-case hex digits, 24+
login       identifier  weak    ``user: name``, ``client_id=...`` and the like
token       secret      weak    40+ base64 characters
endpoint    endpoint    weak    ``scheme://host...`` of databases, brokers, APIs
==========  ==========  ======  =================================================

An identifier needs a secret, an endpoint needs a secret, a weak secret needs
an identifier or an endpoint. A weak span that overlaps a strong one is the
same part and is left out. The interval join of parts to complementary parts
in their scope runs as two ordered passes per document (nearest part of each
role before and after), so its cost is linear: no pair list of a document's
parts is made.

Null text is empty; every row is a document of its own, repeated ids included.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the contract: base patterns and least lengths.
ASSIGN_KEY = "password|passwd|secret|token|api_?key"


def any_case(words: str) -> str:
    """ASCII letters of a pattern in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_SEP = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({any_case(ASSIGN_KEY)}){_SEP}([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = f"^({any_case(ASSIGN_KEY)}){_SEP}([A-Za-z0-9+/_.=-]{{6,}})$"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"      # whole runs: the same spans as runs of any length, 24+ kept
# Weak parts.
LOGIN = f"({any_case('username|user|login|client_id|account')}){_SEP}([A-Za-z0-9_.@-]{{3,64}})"
TOKEN = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = (r"(https?|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://"
            r"[A-Za-z0-9.:@_-]+")
REACH = 200

# What every match of a kind holds: a cheap test before the pattern is tried.
HOLDS = {"assign": (":", "="), "access": ("AKIA",), "login": (":", "="), "endpoint": ("://",)}

# kind -> (pattern, least code points or None, order, role, strong)
KINDS = {
    "assign": (ASSIGN, None, 0, "S", True),
    "access": (ACCESS, 20, 1, "I", True),
    "hex": (HEX, 24, 2, "S", True),
    "login": (LOGIN, None, 3, "I", False),
    "token": (TOKEN, None, 4, "S", False),
    "endpoint": (ENDPOINT, None, 5, "E", False),
}


def _parts(kind: str, text: Column) -> Column:
    """Array of (kind, nth, gap, size, good): each match with the code points
    since the one before it. Splitting and extracting walk the same matches."""
    pattern, least, order, _, _ = KINDS[kind]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("m"))
    good = (lambda m: F.char_length(m) >= least) if least else (lambda m: F.lit(True))
    if kind == "assign":
        good = lambda m: m.rlike(ASSIGN_VALUE)
    part = F.transform(zipped, lambda z, i: F.struct(
        F.lit(order).alias("kind"), i.alias("nth"), z["gap"].alias("gap"),
        F.char_length(z["m"]).alias("size"), F.coalesce(good(z["m"]), F.lit(False)).alias("good"),
        z["m"].isNotNull().alias("real")))
    none = F.filter(part, lambda x: F.lit(False))
    may = F.lit(True)
    if kind in HOLDS:
        may = functools.reduce(Column.__or__, [F.contains(text, F.lit(x)) for x in HOLDS[kind]])
    return F.when(may & text.rlike(pattern), F.filter(part, lambda x: x["real"])).otherwise(none)


def find_parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per part (and one, with null kind, per document without any):
    row, doc_id, kind (its order), start, end.

    Positions are running sums of gaps and sizes within (row, kind)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", body.alias("body"))
    found = rows.select("row", "doc_id", F.explode_outer(F.concat(
        *[_parts(k, F.col("body")) for k in KINDS])).alias("p"))
    flat = found.select("row", "doc_id", "p.kind", "p.nth", "p.gap", "p.size", "p.good")
    upto = (Window.partitionBy("row", "kind").orderBy("nth")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    return (flat.repartition("row").withColumn("end", end)
            .withColumn("start", F.col("end") - F.col("size"))
            .withColumn("kind", F.when(F.col("good"), F.col("kind")))
            .select("row", "doc_id", "kind", "start", "end"))


def _among(kind: Column, test) -> Column:
    return kind.isin(*[v[2] for v in KINDS.values() if test(v)])


def link_parts(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Adds ``strong`` and ``reported``: the interval join, as nearest parts of
    each role on both sides."""
    kind = F.col("kind")
    order = [F.col("start"), F.col("kind")]
    w = Window.partitionBy("row").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # a running minimum from the right: a frame open to the right is computed anew for each row
    after = (Window.partitionBy("row").orderBy(*[c.desc() for c in order])
             .rowsBetween(Window.unboundedPreceding, -1))
    out = parts.withColumn("strong", _among(kind, lambda v: v[4]))
    of = {role: _among(kind, lambda v, role=role: v[3] == role) for role in "SIE"}
    of["strong"] = _among(kind, lambda v: v[4])
    out = out.withColumns({f"left_{x}": F.max(F.when(is_x, F.col("end"))).over(before)
                           for x, is_x in of.items()})
    out = out.withColumns({f"right_{x}": F.min(F.when(is_x, F.col("start"))).over(after)
                           for x, is_x in of.items()})

    def near(role: str) -> Column:
        return (F.coalesce(F.col("start") - F.col(f"left_{role}") <= reach, F.lit(False))
                | F.coalesce(F.col(f"right_{role}") - F.col("end") <= reach, F.lit(False)))

    covered = (F.coalesce(F.col("left_strong") > F.col("start"), F.lit(False))
               | F.coalesce(F.col("right_strong") < F.col("end"), F.lit(False)))
    secret = _among(kind, lambda v: v[3] == "S")
    linked = F.when(secret, near("I") | near("E")).otherwise(near("S"))
    reported = kind.isNotNull() & (F.col("strong") | (~covered & linked))
    return out.withColumn("reported", reported).select(
        "row", "doc_id", "kind", "start", "end", "strong", "reported")


def scan(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Per document row: doc_id, n_assign, n_access, n_hex, base_spans, spans,
    n_linked (weak spans reported)."""
    found = link_parts(find_parts(docs, text), reach)
    names = F.array(*[F.lit(k) for k in KINDS])
    item = F.struct("start", "kind", "end")

    def spans(which: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(which, item)))
        return F.array_join(F.transform(listed, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
            s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == KINDS[kind][2], 1)).alias(f"n_{kind}")

    reported = F.coalesce("reported", F.lit(False))
    return found.groupBy("row", "doc_id").agg(
        count("assign"), count("access"), count("hex"),
        spans(F.col("strong")).alias("base_spans"), spans(reported).alias("spans"),
        F.count(F.when(reported & ~F.col("strong"), 1)).alias("n_linked")).drop("row")
