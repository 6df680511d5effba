"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score. DataFrame functions only.

A span's place is found without Python: a text cut at a pattern (``split``) and the pattern's matches
(``regexp_extract_all``) alternate, so running lengths give every start and end in code points. Each row is judged by
itself: one scan and projection, no shuffle. A cheap test skips a pattern for texts that can't hold it.

Time and stack are linear in a text, however long its runs are: repeated groups are possessive, which the regex engine runs
as loops (a plain one recurses for each turn), and a pattern that begins with a run starts only where the run or the last
match does, as a later start in the same run can't do better. Running lengths are summed in blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Kind, pattern (the matches of the plain forms, in possessive ones), a necessary condition of an accepted
#: match, words that make one likelier.
KINDS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@", "mail|contact|write|reply"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "ip|host|server|address"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}+", "card|visa|credit|payment"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]{6,}[0-9]", "phone|tel|call|mobile|fax"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", "iban|account|bank|konto"),
}
BASE = ("email", "ip", "card", "phone")
#: The score of a kind that nothing but its pattern confirms, that of one with a checksum, and what a context word adds.
PATTERN_SCORE, CHECKSUM_SCORE, CONTEXT_SCORE, CONTEXT_CHARS = 0.6, 0.8, 0.2, 40
#: Lengths in a block of running sums.
BLOCK = 128
_SPAN = "struct<start:int,end:int,value:string,before:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _within(block: Column) -> Column:
    """Running sums of one block."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(block, start, lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"] + x)).alias("out")), lambda acc: acc["out"])


def _running(lengths: Column) -> Column:
    """Running sums of ``array<int>``: an array grows by copying, so it is kept to a block, and one entry for each block."""

    def of(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: _within(F.slice(all_, b * BLOCK + 1, BLOCK)))
        return _let(blocks, lambda bs: F.flatten(F.zip_with(bs, _within(F.transform(bs, lambda x: F.element_at(x, -1))), lambda x, end: F.transform(x, lambda v: v + end - F.element_at(x, -1)))))

    return _let(lengths, lambda x: F.when(F.size(x) > 0, of(x)).otherwise(x))


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value,before>> of the leftmost matches that don't overlap; ``before``: the end of what lies between
    a match and the last one."""
    return _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(
            _let(
                F.zip_with(F.slice(F.split(text, pattern), F.lit(1), F.size(found)), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("own"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before"), m.alias("value"))),
                lambda each: F.zip_with(each, _running(F.transform(each, lambda x: x["gap"] + x["own"])), lambda x, end: F.struct((end - x["own"]).alias("start"), end.alias("end"), x["value"].alias("value"), x["before"].alias("before"))),
            )
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    back = F.reverse(_digits(value))
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(F.sequence(F.lit(0), F.length(back) - 1), lambda i: F.transform(F.array(F.substr(back, i + 1, F.lit(1)).cast("int")), lambda d: F.when(i % 2 == 1, doubled(d)).otherwise(d))[0])
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether ``value`` passes the mod-97 check of an account number, first four characters last."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    codes = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substr(turned, i, F.lit(1))))
    return F.aggregate(codes, F.lit(0), lambda a, c: F.when(c >= 65, (a * 100 + c - 55) % 97).otherwise((a * 10 + c - 48) % 97)) == 1


def _low_parts(value: Column) -> Column:
    return value.rlike(r"^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(\.0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")


#: What confirms a match of each kind.
CONFIRMED: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": _low_parts,
    "card": lambda v: F.when(F.length(_digits(v)).between(16, 19), luhn(v)).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
    "iban": mod97,
}


def _entities(text: Column, kind: str) -> Column:
    pattern, needs, context = KINDS[kind]
    kept = F.filter(_spans(text, pattern), lambda s: CONFIRMED[kind](s["value"]))
    score = CHECKSUM_SCORE if kind in ("card", "iban") else PATTERN_SCORE

    def scored(s: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.when(s["before"].rlike(f"(?i)\\b({context})"), F.lit(score + CONTEXT_SCORE)).otherwise(F.lit(score)).alias("score"))

    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")
    return F.when(text.rlike(needs), F.transform(kept, scored)).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``docs`` with ``entities``: array of (kind, start, end, value, score), by kind as in ``KINDS``, then start.

    Places count code points, ends are exclusive. Null and empty texts have no entities. Spans of one kind don't overlap;
    those of two kinds may. A score looks at CONTEXT_CHARS characters before the span, back to the last one of its pattern.
    Texts of any length and with runs of any length are read whole, in time that grows with the text. Rows are judged each
    by itself, so repeated rows get equal results, ties can't arise, and an empty table gives an empty one; a column
    called ``entities`` is replaced.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("entities", F.concat(*[_entities(source, k) for k in kinds]))


def redact(docs: DataFrame, text: str = "text", least: float = 0.6) -> DataFrame:
    """``docs`` with every span of ``find_pii`` that scores ``least`` replaced by its kind in angle brackets.

    Of spans that overlap, the one that starts first goes, of those the longest. Null and empty texts stay as they are; the
    text is copied once for each span.
    """
    order = lambda es: F.array_sort(F.filter(es, lambda e: e["score"] >= least), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    found = find_pii(docs.select("*", F.col(text).alias("_text")), "_text")

    def step(acc: Column, e: Column) -> Column:
        piece = F.concat(acc["out"], F.substr(F.col("_text"), acc["at"] + 1, F.greatest(e["start"] - acc["at"], F.lit(0))), F.lit("<"), e["kind"], F.lit(">"))
        return F.when(e["start"] < acc["at"], acc).otherwise(F.struct(e["end"].alias("at"), piece.alias("out")))

    whole = F.aggregate(order(F.col("entities")), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(F.col("_text"), acc["at"] + 1)))
    return found.withColumn(text, F.when(F.size("entities") > 0, whole).otherwise(F.col("_text"))).select(*docs.columns)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts of the base kinds, the hash of their spans, all spans as text, and their scores."""
    listed = lambda es: F.array_join(F.transform(es, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("entities", lambda e: e["kind"].isin(*BASE))
    scores = F.array_join(F.transform("entities", lambda e: F.round(e["score"], 1).cast("string")), ",")
    return found.select(id_col, *[of(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("entities")).alias("spans"), scores.alias("scores"))
