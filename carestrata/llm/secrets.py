"""Secrets in texts: fixed patterns, and entropy in sliding windows of candidates.

Everything here is an expression of Spark's own; a scan has no shuffle and no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.rows import free_names

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

#: Runs that entropy is measured in, and the window that slides over them.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character classes: a pattern of the whole run, its alphabet, bits per character to reach.
CLASSES = (
    (r"^[0-9]+$", "0123456789", 3.25),
    (r"^[0-9A-Fa-f]+$", "0123456789abcdef", 3.0),
    (r"^[A-Za-z]+$", "abcdefghijklmnopqrstuvwxyz", 4.0),
    (r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.6),
)
#: Runs that are known not to be secrets: rulers, paths of words (words of under 20 letters with
#: one separator between them, a slash before them at most), identifiers of the 8-4-4-4-12 form.
#: No pattern repeats a group: that would take a call per repeat, and a long run the whole stack.
ALLOWED = (
    r"^[-_=+/]+$",
    r"^(?=/?[A-Za-z]+[-_/=+])(?!.*[A-Za-z]{20})(?!.+[-_/=+]{2})[A-Za-z/_=+-]+$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
)
#: Words that mark samples: a window that holds one whole is no secret.
SAMPLES = r"(?i)example|placeholder|changeme|dummy|sample"
#: Sums of c*log2(c) are kept as whole millionths, so that they do not depend on their order.
_UNIT = 1_000_000
_TERMS = [round(_UNIT * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once: what a lambda names from outside is made anew per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (start, kind, end) of the matches that ``keep`` (match, number) accepts.

    Positions are code points: what lies between the matches is split off and its
    lengths are added up. Texts without a match are searched once only.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g")), lambda x: F.struct(F.length(x["g"]).alias("g"), F.length(x["m"]).alias("m")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    placed = F.aggregate(
        lengths,
        start,
        lambda s, x: F.struct(
            (s["at"] + x["g"] + x["m"]).alias("at"),
            F.array_append(
                s["spans"],
                F.struct((s["at"] + x["g"]).alias("start"), F.lit(kind).alias("kind"), (s["at"] + x["g"] + x["m"]).alias("end")),
            ).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    found = F.filter(placed, keep) if keep else placed
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """The spans of the three fixed kinds, leftmost and not overlapping per kind.

    Access keys and hex runs match as far as their characters go, so their least
    length may stand in the pattern. An assignment that fails still uses up its text:
    it is matched at any length and dropped afterwards.
    """
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)
    assign = _spans(text, ASSIGN, 0, None)
    judged = F.arrays_zip(assign.alias("s"), long_enough.alias("fine"))
    kept = F.transform(F.filter(judged, lambda x: x["fine"]), lambda x: x["s"])
    assign = F.when(F.size(assign) > 0, kept).otherwise(assign)
    access = _spans(text, f"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}", 1, None)
    hexes = _spans(text, f"[0-9a-f]{{{HEX_LEAST},}}", 2, None)
    return F.concat(assign, access, hexes)


def _window_hull(run: Column, alphabet: str, bits: float) -> Column:
    """(first, last) of the windows whose entropy reaches ``bits``; null if none does.

    The counts of a window's characters are carried along: the one that enters adds
    to its count, the one that leaves takes from its own, and the sum of c*log2(c)
    changes by those two terms only. ``entropy = log2(w) - sum/w``.
    """
    most = math.floor(_UNIT * WINDOW * (math.log2(WINDOW) - bits))
    terms = F.array(*(F.lit(t).cast("long") for t in _TERMS))
    places = F.transform(F.split(run, ""), lambda c: F.position(c, F.lit(alphabet)))

    def step(s: Column, x: Column) -> Column:
        enters, leaves = x["enters"], x["leaves"]
        left = F.coalesce(F.get(s["counts"], leaves - 1), F.lit(0))
        lower = F.when(left > 0, F.get(terms, left) - F.get(terms, left - 1)).otherwise(F.lit(0))
        had = F.get(s["counts"], enters - 1) - F.when(enters == leaves, 1).otherwise(0)
        total = s["sum"] - lower + F.get(terms, had + 1) - F.get(terms, had)
        counts = F.transform(
            s["counts"],
            lambda c, i: c + F.when(i == enters - 1, 1).otherwise(0) - F.when(i == leaves - 1, 1).otherwise(0),
        )
        hit = (x["i"] >= WINDOW) & (total <= most)
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hit & s["first"].isNull(), x["i"] - WINDOW).otherwise(s["first"]).alias("first"),
            F.when(hit, x["i"]).otherwise(s["last"]).alias("last"),
        )

    moves = _bound(
        places,
        lambda all_places: F.transform(
            all_places,
            lambda p, i: F.struct(
                (i + 1).alias("i"),
                p.alias("enters"),
                F.when(i >= WINDOW, F.get(all_places, i - WINDOW)).otherwise(F.lit(0)).alias("leaves"),
            ),
        ),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _between(cuts: Column, first: Column, last: Column, over: int) -> Column:
    """(start, end) of what of ``first`` to ``last`` lies between ``cuts``, if a window has room.

    Cuts are in order. With ``over`` 1 a piece reaches into the cuts beside it, short of
    holding one whole; with 0 it stops at them.
    """
    piece = "struct<start:int,end:int>"
    start = F.struct(first.alias("at"), F.array().cast(f"array<{piece}>").alias("out"))

    def added(out: Column, at: Column, end: Column) -> Column:
        return F.when(end - at >= WINDOW, F.array_append(out, F.struct(at.alias("start"), end.alias("end")))).otherwise(out)

    def step(s: Column, c: Column) -> Column:
        if over:
            at, end = c["start"] + 1, c["end"] - 1
        else:
            at, end = F.greatest(s["at"], c["end"]), c["start"]
        return F.struct(at.alias("at"), added(s["out"], s["at"], end).alias("out"))

    return F.aggregate(cuts, start, step, lambda s: added(s["out"], s["at"], last))


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of candidate runs by entropy, except allowed runs and what ``base`` spans cover.

    Windows that touch a base span, or hold a word of ``SAMPLES``, are left out: what
    is between them is searched piece by piece. Pieces are judged by the class of the
    whole run, and the windows found between two base spans make one span, which takes
    sample words it reaches into whole.
    """

    def hull(run: Column, own: Column) -> Column:
        found = None
        for pattern, alphabet, bits in reversed(CLASSES):
            part = F.lower(own) if alphabet.lower() == alphabet else own
            value = _window_hull(part, alphabet, bits)
            found = value if found is None else F.when(run.rlike(pattern), value).otherwise(found)
        return found

    def fine(run: Column) -> Column:
        return ~run.rlike("|".join(f"(?:{p})" for p in ALLOWED))

    def inside(whole: Column, piece: Column) -> Column:
        """The (first, last) of a piece's windows, from the start of the run on; null if it has none."""
        words = F.filter(whole["words"], lambda w: (piece["start"] <= w["start"]) & (w["end"] <= piece["end"]))
        parts = _between(words, piece["start"], piece["end"], 1)
        at = F.transform(parts, lambda p: F.struct(p["start"].alias("start"), hull(whole["run"], F.substring(whole["run"], p["start"] + 1, p["end"] - p["start"])).alias("hull")))
        hits = F.transform(F.filter(at, lambda h: h["hull"]["first"].isNotNull()), lambda h: F.struct((h["start"] + h["hull"]["first"]).alias("first"), (h["start"] + h["hull"]["last"]).alias("last")))
        reach = F.struct(F.array_min(hits["first"]).alias("first"), F.array_max(hits["last"]).alias("last"))
        grown = lambda s, w: F.struct(
            F.when((w["start"] < s["first"]) & (s["first"] < w["end"]), w["start"]).otherwise(s["first"]).alias("first"),
            F.when((w["start"] < s["last"]) & (s["last"] < w["end"]), w["end"]).otherwise(s["last"]).alias("last"),
        )
        return F.aggregate(words, reach, grown)

    runs = _spans(text, CANDIDATE, 3, None)
    with_text = F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("run")))
    left = F.filter(with_text, lambda s: fine(s["run"]))
    known = F.transform(
        left,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["run"].alias("run"),
            _spans(s["run"], SAMPLES, 3, None).alias("words"),
            F.transform(
                _between(F.array_sort(F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))), s["start"], s["end"], 0),
                lambda p: F.struct((p["start"] - s["start"]).alias("start"), (p["end"] - s["start"]).alias("end")),
            ).alias("pieces"),
        ),
    )
    found = F.flatten(
        F.transform(
            known,
            lambda s: F.transform(F.transform(s["pieces"], lambda p: inside(s, p)), lambda h: F.struct((s["start"] + h["first"]).alias("start"), F.lit(3).alias("kind"), (s["start"] + h["last"]).alias("end"))),
        )
    )
    return F.when(F.size(runs) > 0, F.filter(found, lambda s: s["start"].isNotNull())).otherwise(runs)


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def with_spans(docs: DataFrame, text_col: str = "text", base: str = "_base", added: str = "_added") -> DataFrame:
    """``docs`` with the columns ``base`` and ``added``: arrays of (start, kind, end)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(base, base_spans(text)).withColumn(added, entropy_spans(text, F.col(base)))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every document.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind;
    ``base_sha256`` is the digest of the list without the ``entropy`` spans, which
    are windows of high entropy in long runs, unless allowed or touched by a base span.

    Null and empty texts have no spans (the digest is that of an empty list). Null
    and repeated ids, and repeated rows, come back row by row. Texts are searched
    whole. An empty table gives no rows. Other columns are not read.
    """
    rows = with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.concat("_base", "_added")).alias("spans"),
    )


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans by one.

    Texts without spans, null ones included, stay as they are; so do columns of any name.
    """
    base, added = free_names(docs, "_base", "_added")
    rows = with_spans(docs, text_col, base, added)
    text, spans = F.col(text_col), F.array_sort(F.concat(base, added))
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return rows.withColumn(text_col, F.when(F.size(spans) > 0, done).otherwise(text)).drop(base, added)
