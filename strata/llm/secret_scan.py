"""Secret scan: known shapes, and sliding-window entropy over candidate strings.

SQL functions only; one pass over the whole texts without shuffle.

Known shapes (leftmost, non-overlapping per kind): ``assign`` (a credential
name, a sign, a value of 6 or more characters), ``access`` (AKIA and 16 or
more capitals or digits) and ``hex`` (24 or more lower-case hex digits).

Entropy: a candidate is a run of 20 or more token characters. For each
character class a window of 20 characters slides over it. Per step the count
of the character that enters goes up and that of the one that leaves goes
down, and the sum of c * log2(c) changes by those two terms alone; the Shannon
entropy of the window is log2(20) - sum / 20. Windows wholly inside the class
at or above its limit are spans; overlapping ones are one span. Paths, dates and
names are rich in characters, too, but change between digits, capitals and small
letters only where their words do: a window must hold a number of such changes,
counted in the same way. Candidates on the allow-list, segments with an allow-listed word and spans inside a known
shape are suppressed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the known shapes, in the order in which kinds are listed.
# Letters of the names are in either case (ASCII only, hence no (?u)).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Character classes of the entropy scan: alphabet, limit in bits (the most a
# window of 20 can have is 4.32, for hex digits 3.92) and least number of changes.
CLASSES = {
    "entropy_hex": (DIGITS + "abcdefABCDEF", 2.9, 2),
    "entropy_base36": (DIGITS + LOWER, 3.4, 2),
    "entropy_base64": (DIGITS + LOWER + LOWER.upper() + "+/_=-", 3.6, 3),
}
# Two characters that change between digits, capitals and small letters; a
# capital before small letters begins a word and is none.
CHANGE = "[a-z][A-Z0-9]|[0-9][a-zA-Z]|[A-Z][0-9]"
# A candidate on the allow-list is no secret by its entropy: words without a
# digit, numbers, UUIDs, names of small or capitalised words with a number at
# their end, running alphabets and stated examples. The last pattern
# suppresses only the segment (ended by one of /_=) that holds its word.
ALLOW = (
    r"^[^0-9]*$",
    r"^[0-9_=-]*$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^(?:[/_=-]*+[A-Z]?+[a-z]++)++[/_=-]*+[0-9]{0,4}$",
    r"(?i)0123456789|abcdefgh|example|placeholder|changeme",
)
KINDS = ("assign", "access", "hex", *CLASSES)


def _matches(text: Column, pattern: str, keep_group: int | None = None) -> Column:
    """``array<struct<start, end, match>>`` of the pattern's matches in code
    points, end exclusive. The text is cut at the matches; the lengths of cuts
    and matches in turn give the places. ``keep_group``: only matches whose
    group of that number has ``ASSIGN_VALUE`` characters or more."""
    lit = F.lit(pattern)
    found = F.regexp_extract_all(text, lit, F.lit(0))
    group = F.regexp_extract_all(text, lit, F.lit(keep_group)) if keep_group else found
    cuts = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.arrays_zip(cuts.alias("cut"), found.alias("found"), group.alias("part"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["cut"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("match"))
        kept = F.concat(acc["out"], F.array(span))
        if keep_group:
            kept = F.when(F.length(x["part"]) >= ASSIGN_VALUE, kept).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    spans = F.aggregate(steps, zero, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _entropy_spans(candidate: Column, alphabet: str, limit: float, changes: int) -> Column:
    """``array<struct<start, end>>`` within a candidate string (ASCII)."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    n = len(alphabet)
    spans_type = "array<struct<start:int,end:int>>"
    zero = F.struct(
        F.array_repeat(F.lit(0), n).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("outside"),
        F.lit(0).alias("turns"),
        F.array().cast(spans_type).alias("spans"),
    )

    def step(acc: Column, i: Column) -> Column:
        # Place in the alphabet from 1; 0: another character, or none leaves yet.
        enters = F.position(F.substring(candidate, i, F.lit(1)), F.lit(alphabet))
        gone = i > WINDOW
        leaves = F.when(gone, F.position(F.substring(candidate, i - WINDOW, F.lit(1)), F.lit(alphabet))).otherwise(F.lit(0))
        had_in = F.coalesce(F.get(acc["counts"], enters - 1), F.lit(0))
        had_out = F.coalesce(F.get(acc["counts"], leaves - 1), F.lit(0)) + F.when(leaves == enters, 1).otherwise(0)
        grown = F.when(enters > 0, F.get(table, had_in + 1) - F.get(table, had_in)).otherwise(F.lit(0.0))
        shrunk = F.when(leaves > 0, F.get(table, had_out) - F.get(table, had_out - 1)).otherwise(F.lit(0.0))
        total = acc["sum"] + grown - shrunk
        outside = (
            acc["outside"]
            + F.when(enters == 0, 1).otherwise(0)
            - F.when(gone & (leaves == 0), 1).otherwise(0)
        )
        change = lambda at: F.when(F.substring(candidate, at, F.lit(2)).rlike(CHANGE), 1).otherwise(0)
        turns = acc["turns"] + F.when(i > 1, change(i - 1)).otherwise(0) - F.when(gone, change(i - WINDOW)).otherwise(0)
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + F.when(k == enters - 1, 1).otherwise(0) - F.when(k == leaves - 1, 1).otherwise(0),
        )
        high = (i >= WINDOW) & (outside == 0) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= limit) & (turns >= changes)
        start = (i - WINDOW).cast("int")
        last = F.get(acc["spans"], F.size(acc["spans"]) - 1)
        head = F.slice(acc["spans"], F.lit(1), F.greatest(F.size(acc["spans"]) - 1, F.lit(0)))

        def span(a: Column) -> Column:
            return F.array(F.struct(a.alias("start"), i.cast("int").alias("end")))

        spans = (
            F.when(~high, acc["spans"])
            .when(last["end"] >= start, F.concat(head, span(last["start"])))
            .otherwise(F.concat(acc["spans"], span(start)))
        )
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            outside.cast("int").alias("outside"),
            turns.cast("int").alias("turns"),
            spans.cast(spans_type).alias("spans"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), zero, step, lambda acc: acc["spans"])


def secret_spans(text: Column) -> dict[str, Column]:
    """Per kind an ``array<struct<start, end, match>>`` of a non-null text."""
    return {
        "assign": _matches(text, ASSIGN, keep_group=2),
        "access": _matches(text, ACCESS),
        "hex": _matches(text, HEX),
    }


def _joined(spans: Column) -> Column:
    named = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(named, ",")


def _placed(spans: Column, kind: str) -> Column:
    """Spans that sort by start, then by the kinds as listed."""
    at = F.lit(KINDS.index(kind))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), at.alias("kind"), s["end"].alias("end")))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``secrets`` (``array<struct<start, kind, end>>``; kind is a
    place in ``KINDS``) and the columns of the digest: ``n_assign, n_access,
    n_hex, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` by start, then kind, comma-joined;
    ``base_sha256`` is the SHA-256 of that list of the known shapes alone.
    Places count code points, end exclusive.

    Defined cases: a null or empty text has no spans; each repeated row is
    scanned; other columns pass through, those with the names added here are
    replaced; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumns({f"__{k}": c for k, c in secret_spans(text).items()})
    d = d.withColumn("__candidates", _matches(text, CANDIDATE))
    *clear, words = ALLOW

    def without_words(m: Column) -> Column:
        # A dot is in no class: no window goes over it, and places stay.
        cleared = lambda s: F.when(s.rlike(words), F.repeat(F.lit("."), F.length(s))).otherwise(s)
        return F.when(m.rlike(words), F.array_join(F.transform(F.split(m, "(?<=[/_=])"), cleared), "")).otherwise(m)

    def allowed(m: Column) -> Column:
        hit = m.rlike(clear[0])
        for pattern in clear[1:]:
            hit = hit | m.rlike(pattern)
        return hit

    d = d.withColumn("__candidates", F.transform("__candidates", lambda c: c.withField("match", without_words(c["match"]))))
    d = d.withColumn("__candidates", F.filter("__candidates", lambda c: ~allowed(c["match"])))
    base = F.concat(*[_placed(F.col(f"__{k}"), k) for k in ("assign", "access", "hex")])
    d = d.withColumn("__base", base)
    found = []
    for kind, limits in CLASSES.items():
        def within(c: Column) -> Column:
            spans = _entropy_spans(c["match"], *limits)
            return F.transform(
                spans, lambda s: F.struct((c["start"] + s["start"]).alias("start"), (c["start"] + s["end"]).alias("end"))
            )
        found.append(_placed(F.flatten(F.transform("__candidates", within)), kind))
    # Most texts have no candidate left: they skip the scan.
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    d = d.withColumn("__high", F.when(F.size("__candidates") > 0, F.concat(*found)).otherwise(none))
    inside = lambda s: F.exists("__base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    d = d.withColumn("secrets", F.array_sort(F.concat("__base", F.filter("__high", lambda s: ~inside(s)))))
    d = d.withColumns({
        "n_assign": F.size("__assign").cast("long"),
        "n_access": F.size("__access").cast("long"),
        "n_hex": F.size("__hex").cast("long"),
        "base_sha256": F.sha2(_joined(F.col("__base")).cast("binary"), 256),
        "spans": _joined(F.col("secrets")),
    })
    return d.drop("__assign", "__access", "__hex", "__candidates", "__base", "__high")
