"""Personal data in texts, in DataFrame operations only.

Regular expressions propose spans; a validator of the kind confirms or drops
them (Luhn for cards, mod-97 for bank accounts, part and digit ranges for
addresses and phone numbers). Each confirmed span has a score: that of its
kind, raised if a word of the kind's context stands whole within
``CONTEXT_CHARS`` on either side. Items of a list share a label: a match that
follows another one of its kind within that distance and within the sentence
has the context that this one has. The base kinds pass by their validator
alone; kinds that are mostly noise without context (numbers of a national
phone, secrets) need the context to pass.

Spans come from two aligned arrays: the matches of a pattern and the texts
between them. Running lengths of both give code point offsets, so a text is
never searched match by match; the surroundings of a span are cut from blocks of
the text, not from its start. Patterns use possessive quantifiers and start
only where a run of their characters starts (or the last match ended), so
they take linear time on any text and match what the plain form matches.

Defined results: null and empty texts have no spans. Repeated rows are each
answered; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters on either side of a span in which context words count (below TEXT_BLOCK), and the score a span needs.
CONTEXT_CHARS, THRESHOLD = 40, 0.5
#: Characters of the blocks from which surroundings are cut.
TEXT_BLOCK = 256
#: Matches whose running lengths are added up together.
RUN_BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """``needs``: cheap test that every text with a match passes."""

    name: str
    pattern: str
    needs: str
    score: float
    context: str
    base: bool = True


def _start(chars: str) -> str:
    """Only where a run of these characters starts, or where the last match ended."""
    return rf"(?:(?<![{chars}])|\G)"


_LOCAL = "A-Za-z0-9._%+-"

#: Characters of a bank account number by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
#: An account number of its country's length, so that words after it and a next number are not taken in.
_COUNTRY_IBAN = "|".join(rf"(?:{x.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, x in _IBAN_LENGTHS.items())

#: The base kinds in their order, then further ones. Scores are the base confidence of each.
KINDS = (
    Kind("email", _start(_LOCAL) + rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]", 0.9, r"(?i)\b(mail|email|e-mail|contact|write)\b"),
    Kind("ip", _start("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"(?i)\b(ip|host|server|address|login)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", 0.7, r"(?i)\b(card|credit|visa|mastercard|amex|debit)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, r"(?i)\b(phone|tel|call|mobile|fax|cell)\b"),
    Kind("iban", rf"\b(?:{_COUNTRY_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!(?:{_COUNTRY_IBAN})\b))?[A-Z0-9]){{11,30}})\b", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", 0.8, r"(?i)\b(iban|account|bank|konto|compte)\b", False),
    Kind("national_phone", r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}", 0.2, r"(?i)\b(phone|tel|call|mobile|fax|cell)\b", False),
    Kind("secret", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{32,}+(?![A-Za-z0-9_+/=-])", r"[A-Za-z0-9_+/-]{32}", 0.2, r"(?i)\b(token|secret|password|passwd|api.?key|access.?key)\b", False),
)
#: Fixed value: what a context word adds to a score.
CONTEXT_GAIN = 0.4


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes the mod-97 check: first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    number = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(number, F.lit(0), lambda a, d: (a * F.when(d > 9, 100).otherwise(10) + d) % 97) == 1


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return n.between(13, 19) & luhn(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, block: int = RUN_BLOCK, combine=lambda a, x: a + x) -> Column:
    """Running totals of an array of numbers, by an associative ``combine`` to which 0 is neutral.

    Each block is summed on from the total of the blocks before it. A plain
    aggregation that appends to one array would copy it at every item.
    """
    def summed(items: Column, first: Column) -> Column:
        """``first``, and the running totals that follow from it."""
        return F.aggregate(items, F.array(first), lambda done, x: F.concat(done, F.array(combine(F.element_at(done, -1), x))))

    def over(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(block))
        return _let(F.transform(starts, lambda i: F.slice(v, i, F.lit(block))), by_block)

    def by_block(blocks: Column) -> Column:
        firsts = summed(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), combine)), F.lit(0))
        return F.flatten(F.zip_with(blocks, F.slice(firsts, 1, F.size(blocks)), lambda b, first: F.slice(summed(b, first), F.lit(2), F.size(b))))

    return _let(values, over)


#: What a match tells of its list: LABEL if a context word is near it, APART if no list goes on with it.
LABEL, APART = 1, 2


def _go_on(before: Column, match: Column) -> Column:
    """State of a list after a match: the label stays until a match stands apart."""
    return F.when(match >= APART, match).otherwise(before.bitwiseOR(match))


def _near(blocks: Column, start: Column, stop: Column, context: str) -> Column:
    """Whether a context word stands whole in the text shortly before ``start`` or after ``stop``."""
    def cut(at: Column, size: Column) -> Column:
        i = F.floor(at / TEXT_BLOCK).cast("int")
        two = F.concat(F.get(blocks, i), F.coalesce(F.get(blocks, i + 1), F.lit("")))
        return F.coalesce(F.substr(two, at - i * TEXT_BLOCK + 1, size), F.lit(""))

    # One character more, so that a word that goes on beyond the window is told and taken off.
    wide = F.lit(CONTEXT_CHARS + 1)
    left = cut(F.greatest(start - wide, F.lit(0)), F.least(start, wide))
    left = F.when(start > CONTEXT_CHARS, F.regexp_replace(left, r"^\w+", "")).otherwise(left)
    right = cut(stop, wide)
    right = F.when(F.length(right) > CONTEXT_CHARS, F.regexp_replace(right, r"\w+$", "")).otherwise(right)
    return F.concat(left, F.lit("\n"), right).rlike(context)


def _spans(text: Column, kind: Kind, threshold: float) -> Column:
    """Array of (kind, start, end, score) of the confirmed spans of a kind, by start."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    both = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(
        m.alias("match"), F.length(b).alias("skip"), F.length(m).alias("size"),
        ((F.length(b) > CONTEXT_CHARS) | b.rlike(r"[.!?]\s|\n\s*\n")).alias("apart")))
    placed = _let(both, lambda b: F.zip_with(b, _running(F.transform(b, lambda x: x["skip"] + x["size"])), lambda x, stop: F.struct(
        x["match"].alias("match"), (stop - x["size"]).alias("start"), stop.alias("stop"), x["apart"].alias("apart"))))
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    told = _let(blocks, lambda t: F.transform(placed, lambda s: F.struct(s.alias("s"), (
        F.when(_near(t, s["start"], s["stop"], kind.context), LABEL).otherwise(0) + F.when(s["apart"], APART).otherwise(0)).alias("told"))))
    labelled = _let(told, lambda v: F.zip_with(v, _running(F.transform(v, lambda x: x["told"]), combine=_go_on), lambda x, state: F.struct(
        x["s"].alias("s"), (state.bitwiseAND(F.lit(LABEL)) == LABEL).alias("context"))))
    scored = F.transform(F.filter(labelled, lambda x: _valid(kind.name, x["s"]["match"])), lambda x: F.struct(
        F.lit(kind.name).alias("kind"), x["s"]["start"].alias("start"), x["s"]["stop"].alias("stop"),
        F.least(F.lit(kind.score) + F.when(x["context"], CONTEXT_GAIN).otherwise(0.0), F.lit(1.0)).alias("score")))
    passed = scored if kind.base else F.filter(scored, lambda s: s["score"] >= threshold)
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,score:double>>")
    return F.when(text.rlike(kind.needs), passed).otherwise(none)


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id and found: one array of spans (kind, start, stop, score) for each kind, in their order; map only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", *(_spans(F.col("text"), k, threshold).alias(f"spans_{k.name}") for k in kinds))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def span_digest(found: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256, spans, and their scores in hundredths in the same order."""
    base = [F.col(f"spans_{k.name}") for k in kinds if k.base]
    every = [F.col(f"spans_{k.name}") for k in kinds]
    return found.select(
        "doc_id", *(F.size(f"spans_{k.name}").cast("long").alias(f"n_{k.name}") for k in kinds if k.base),
        F.sha2(_listed(F.concat(*base)), 256).alias("base_sha256"), _listed(F.concat(*every)).alias("spans"),
        F.array_join(F.transform(F.concat(*every), lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"))
