"""Secrets in whole texts: three patterns, and spans of high entropy.

The patterns are key assignments, access key ids and hex runs. The method adds, for
every candidate string, the entropy of a window that slides over it: the counts of
the window's characters change by the one that enters and the one that leaves, and
with them the sum of n log2 n, from which the Shannon entropy follows. Hex strings
and strings of the wider character class have thresholds of their own. The span goes
from the first window at the threshold to the end of the last one. An allow list suppresses
strings that are no secrets, and what a pattern has found is not found again.

NULL counts as empty. Positions are code points, ends exclusive. Repeated rows have
a row each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9+/_.=-]+"""
)
# Whether an assignment's value has eight characters or more.
ASSIGN_VALUE = (
    r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# A text without a digit and a letter close together has no candidate worth a look.
MIXED = r"[A-Za-z][+/_=-]*[0-9]|[0-9][+/_=-]*[A-Za-z]"
# Bits per character that a window has at least: of 4 for hex, of 4.32 for others.
HEX_BITS = 3.0
WIDE_BITS = 3.8
# Symbols of the wider class, at whose places windows are counted.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Allow list: plain words, UUIDs, dates and versions joined by dashes, paths,
# alphabets, and keys that documentation uses. Repeated groups are possessive: Java
# walks through those in a loop, through others by a call per repetition.
ALLOWED = (
    r"^[a-z]+$|^[A-Z]+$|^[0-9]+$|^[A-Z]?[a-z]++(?:[+/_=-]++[A-Za-z]?+[a-z]*+)*+$"
    r"|^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    r"|^[0-9]++(?:[-_/][0-9A-Za-z]{1,8}+)++$|^/?(?:[A-Za-z0-9_-]{1,12}+/)++[A-Za-z0-9_-]{1,12}+$"
    r"|(?i:example|placeholder|changeme|0123456789|abcdefghij|your[_-])"
)

_SPANS = "array<struct<start:int,end:int,text:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap, as (start, end, text).

    What stands between matches and the matches themselves take turns, so their
    lengths give the places.
    """
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(
        F.array().cast(_SPANS).alias("spans"), F.lit(0).alias("at"), F.lit(0).alias("k")
    )

    def walk(gaps: Column) -> Column:
        def step(state: Column, match: Column) -> Column:
            low = state["at"] + F.get(gaps, state["k"])
            high = low + F.char_length(match)
            one = F.struct(low.alias("start"), high.alias("end"), match.alias("text"))
            return F.struct(
                F.concat(state["spans"], F.array(one)).alias("spans"),
                high.alias("at"),
                (state["k"] + 1).alias("k"),
            )

        return F.aggregate(found, start, step, lambda s: s["spans"])

    walked = F.transform(F.array(between), walk)[0]
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_SPANS))


def _n_log_n(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def entropy_span(candidate: Column) -> Column:
    """(start, end) within the candidate from its first hot window to its last, or NULL."""
    chars = F.transform(
        F.split(candidate, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1
    )
    hexed = candidate.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")
    limit = F.when(hexed, F.lit(HEX_BITS)).otherwise(F.lit(WIDE_BITS))
    most = WINDOW * (F.log2(F.lit(float(WINDOW))) - limit)
    start = F.struct(
        F.array_repeat(F.lit(0), len(SYMBOLS)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("at"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )

    def walk(symbols: Column) -> Column:
        def step(state: Column, entering: Column) -> Column:
            leaving = F.when(state["at"] >= WINDOW, F.get(symbols, state["at"] - WINDOW)).otherwise(-1)
            there = F.get(state["counts"], entering)
            gone = F.when(leaving >= 0, F.get(state["counts"], leaving))
            # The same symbol enters and leaves: nothing changes.
            change = F.when(entering == leaving, F.lit(0.0)).otherwise(
                _n_log_n(there + 1)
                - _n_log_n(there)
                + F.coalesce(_n_log_n(gone - 1) - _n_log_n(gone), F.lit(0.0))
            )
            counts = F.transform(
                state["counts"],
                lambda n, s: n + (s == entering).cast("int") - (s == leaving).cast("int"),
            )
            total = state["sum"] + change
            hot = (state["at"] >= WINDOW - 1) & (total <= most + 1e-9)
            return F.struct(
                counts.alias("counts"),
                total.alias("sum"),
                (state["at"] + 1).alias("at"),
                F.when(hot & (state["first"] < 0), state["at"] - (WINDOW - 1))
                .otherwise(state["first"])
                .alias("first"),
                F.when(hot, state["at"] + 1).otherwise(state["last"]).alias("last"),
            )

        return F.aggregate(
            symbols,
            start,
            step,
            lambda s: F.when(
                s["first"] >= 0, F.struct(s["first"].alias("start"), s["last"].alias("end"))
            ),
        )

    return F.transform(F.array(chars), walk)[0]


def _kind(found: Column, name: str, place: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(place).alias("place"),
            s["end"].alias("end"),
            F.lit(name).alias("kind"),
        ),
    )


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(
            F.array_sort(found),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id with the spans of each kind: base and extra, arrays of (start, place, end, kind).

    `hot` has every candidate with a window at the threshold, also where a pattern found
    it; `extra` those that no pattern found.
    """
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    value = lambda s: F.char_length(F.regexp_extract(s["text"], ASSIGN_VALUE, 1))
    wanted = F.filter(
        spans(text, CANDIDATE),
        lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]") & ~s["text"].rlike(ALLOWED),
    )
    rows = rows.withColumns(
        {
            "assign": F.filter(spans(text, ASSIGN), lambda s: value(s) >= 8),
            "access": spans(text, ACCESS),
            "hex": spans(text, HEX),
            "_wanted": F.when(text.rlike(CANDIDATE) & text.rlike(MIXED), wanted).otherwise(
                F.array().cast(_SPANS)
            ),
        }
    ).drop("text")
    base = F.concat(
        _kind(F.col("assign"), "assign", 0),
        _kind(F.col("access"), "access", 1),
        _kind(F.col("hex"), "hex", 2),
    )
    rows = rows.withColumn("base", base)
    hot = F.transform(
        "_wanted",
        lambda s: F.struct(
            s["start"].alias("at"), s["end"].alias("to"), entropy_span(s["text"]).alias("span")
        ),
    )
    rows = rows.withColumn("hot", F.filter(hot, lambda h: h["span"].isNotNull()))
    fresh = F.filter(
        "hot", lambda h: ~F.exists("base", lambda b: (b["start"] < h["to"]) & (h["at"] < b["end"]))
    )
    extra = F.transform(
        fresh,
        lambda h: F.struct(
            (h["at"] + h["span"]["start"]).alias("start"),
            F.lit(3).alias("place"),
            (h["at"] + h["span"]["end"]).alias("end"),
            F.lit("entropy").alias("kind"),
        ),
    )
    return rows.select("doc_id", "assign", "access", "hex", "base", "hot", extra.alias("extra"))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy, n_hot."""

    def number(name: str) -> Column:
        return F.size(name).cast("bigint")

    return find_secrets(docs).select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "extra")).alias("spans"),
        number("extra").alias("n_entropy"),
        number("hot").alias("n_hot"),
    )
