"""Operator 12: personal data, by patterns, checksums and context words (native: no Python workers).

For each kind a regular expression proposes spans, leftmost first and without overlaps. A validator
confirms them: Luhn for cards, mod-97 for account numbers (IBAN), ranges for network addresses and
numbers of digits for phones. The words before and after a span raise or lower its score.

* Base kinds (email, ip, card, phone) are spans of their pattern that pass the validator. They stay
  whatever their score. A proposed span that fails is dropped, and no shorter or later one is
  tried in its place.
* Added kinds need a score of ``LEAST_SCORE``. An account number has it by its checksum; a social
  security number or a phone number without a country code only by a word such as "phone" nearby.

Everything is a projection of a row: no shuffle, no broadcast. A text is cut at its matches
(``split`` and ``regexp_extract_all`` make the same ones), so a span's place is the running sum of
the lengths of the parts before it. The running sums are taken in blocks of ``BLOCK`` matches, so
their cost grows with the number of matches and not with its square. The patterns take time in
proportion to a text: where a run of letters or digits could be tried from each of its characters,
possessive repeats and a look behind allow its first one only, which finds the same matches.

Defined results: a null text counts as empty; an empty text and one without a match have no spans.
Places are code points from 0, the end exclusive. Texts are searched whole, whatever their length.
Every row gives one row, also where ids are null or repeated. Columns other than the id and the
text are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.common import lower_ascii

LEAST_SCORE = 0.5
# Code points before and after a span in which words count.
BEFORE, AFTER = 40, 20
# What a supporting word adds to a score, and a contradicting one takes from it.
SUPPORT, AGAINST = 0.3, 0.3
BLOCK = 512
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"

# Words that support a kind or speak against it (lower case).
MAIL_WORDS = "contact|email|e-mail|mail|write"
HOST_WORDS = "address|host|ip|login|server"
VERSION_WORDS = "release|section|version"
CARD_WORDS = "card|credit|debit|karte|mastercard|payment|tarjeta|visa"
NUMBER_WORDS = "barcode|isbn|order|serial|tracking"
PHONE_WORDS = "call|cell|fax|mobile|phone|tel|telefon|teléfono|téléphone"
ACCOUNT_WORDS = "account|bank|bic|iban|konto|transfer"
SOCIAL_WORDS = "social security|ssn"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _all_parts_small(hit: Column) -> Column:
    """The four numbers are at most 255."""
    return hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")


def _luhn(hit: Column) -> Column:
    return F.length(_digits(hit)).between(16, 19) & F.call_function("luhn_check", _digits(hit))


def _few_digits(hit: Column) -> Column:
    return F.length(_digits(hit)).between(8, 15)


def _mod_97(hit: Column) -> Column:
    """An account number: the country and check digits moved to the end, letters as 10 to 35, modulo 97 is 1."""
    compact = F.translate(hit, " ", "")
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    digit = lambda c: F.ascii(c) < 65
    step = lambda rest, c: (rest * F.when(digit(c), 10).otherwise(100) + F.ascii(c) - F.when(digit(c), 48).otherwise(55)) % 97
    return F.length(compact).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def _social(hit: Column) -> Column:
    return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")


@dataclasses.dataclass(frozen=True)
class Kind:
    """``apart``: patterns that the text just before and just after a span mustn't match."""

    name: str
    pattern: str
    score: float
    support: str
    against: str | None = None
    valid: Callable[[Column], Column] | None = None
    base: bool = False
    apart: tuple[str, str] | None = None
    needs: str | None = None


KINDS = [
    # Fixed values, up to repeats made possessive and looks behind: the patterns of the base kinds.
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, MAIL_WORDS, base=True, needs="@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, HOST_WORDS, VERSION_WORDS, _all_parts_small, base=True, needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, CARD_WORDS, NUMBER_WORDS, _luhn, base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, PHONE_WORDS, NUMBER_WORDS, _few_digits, base=True, needs="+"),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", 0.7, ACCOUNT_WORDS, None, _mod_97,
        apart=("[A-Za-z0-9]$", "^[A-Za-z0-9]"),
    ),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, SOCIAL_WORDS, NUMBER_WORDS, _social, apart=("[0-9-]$", "^[0-9-]"), needs="-"),
    Kind(
        "local_phone", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", 0.3, PHONE_WORDS, NUMBER_WORDS,
        apart=(r"[0-9+][\x20().-]*$", r"^[\x20.-]?[0-9]"),
    ),
]
BASE_KINDS = [k.name for k in KINDS if k.base]


# -- one kind -------------------------------------------------------------------
def _cut(kind: Kind, text: Column) -> tuple[Column, Column]:
    """(parts of the text between the kind's matches, the matches)."""
    gaps, hits = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    if kind.needs is None:
        return gaps, hits
    some = F.contains(text, F.lit(kind.needs))
    none = F.array().cast("array<string>")
    return F.when(some, gaps).otherwise(F.array(text)), F.when(some, hits).otherwise(none)


def _near(words: str, before: Column, after: Column) -> Column:
    pattern = f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"
    return before.rlike(pattern) | after.rlike(pattern)


def _score(kind: Kind, hit: Column, gap: Column, following: Column) -> Column:
    """The span's score; null where a validator rejects it, or an added kind has too low a score."""
    before, after = lower_ascii(F.substring(gap, -BEFORE, BEFORE)), lower_ascii(F.substring(following, 1, AFTER))
    score = F.lit(kind.score) + F.when(_near(kind.support, before, after), SUPPORT).otherwise(0.0)
    if kind.against:
        score = score - F.when(_near(kind.against, before, after), AGAINST).otherwise(0.0)
    score = F.round(F.least(score, F.lit(1.0)), 2)
    fine = F.lit(True) if kind.valid is None else kind.valid(hit)
    if kind.apart:
        fine = fine & ~F.substring(gap, -BEFORE, BEFORE).rlike(kind.apart[0]) & ~F.substring(following, 1, AFTER).rlike(kind.apart[1])
    if not kind.base:
        fine = fine & (score >= LEAST_SCORE)
    return F.when(fine, score)


def _item(kind: Kind, gaps: Column) -> Callable[[Column, Column], Column]:
    """Of match number i: the size of the part before it, its own, and its score."""

    def item(hit: Column, i: Column) -> Column:
        score = _score(kind, hit, gaps[i], gaps[i + 1])
        return F.struct(F.length(gaps[i]).alias("gap"), F.length(hit).alias("size"), score.alias("score"))

    return item


def _shown(kind: Kind, gaps: Column, hits: Column) -> Callable[[Column, Column], Column]:
    """Part number i of a text and the match after it, redacted."""

    def shown(gap: Column, i: Column) -> Column:
        hit = F.get(hits, i)
        dropped = _score(kind, hit, gap, F.get(gaps, i + 1)).isNull()
        return F.concat(gap, F.when(hit.isNull(), "").when(dropped, hit).otherwise(f"[{kind.name.upper()}]"))

    return shown


def _spans(kind: Kind, items: Column) -> Column:
    """The spans of ``items`` (gap, size and score of each match, in order)."""
    span = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"
    zero = lambda at, kept: F.struct(at.cast("bigint").alias("at"), F.array().cast(kept).alias("kept"))

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["size"]
        found = F.struct(
            F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), x["score"].alias("score"), F.lit(kind.base).alias("base")
        )
        kept = F.when(x["score"].isNull(), state["kept"]).otherwise(F.concat(state["kept"], F.array(found)))
        return F.struct(end.alias("at"), kept.alias("kept"))

    def add_block(state: Column, block: Column) -> Column:
        end = state["at"] + F.aggregate(block, F.lit(0).cast("bigint"), lambda n, x: n + x["gap"] + x["size"])
        kept = F.aggregate(block, zero(state["at"], span), add, lambda s: s["kept"])
        return F.struct(end.alias("at"), F.concat(state["kept"], F.array(kept)).alias("kept"))

    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))
    return F.flatten(F.aggregate(blocks, zero(F.lit(0), f"array<{span}>"), add_block, lambda s: s["kept"]))


# -- the operator -----------------------------------------------------------------
def find_personal_data(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id column, and ``spans`` (kind, start, end, score, base; by kind as in ``KINDS``, then
    start) of every row."""
    cut = []
    for kind in KINDS:
        gaps, hits = _cut(kind, F.col("text"))
        cut += [gaps.alias(f"gaps_{kind.name}"), hits.alias(f"hits_{kind.name}")]
    # Each of these steps reads the one before more than once for a row, so none is computed twice.
    rows = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", *cut)
    items = [F.transform(f"hits_{k.name}", _item(k, F.col(f"gaps_{k.name}"))).alias(f"items_{k.name}") for k in KINDS]
    rows = rows.select("id", *items)
    return rows.select(F.col("id").alias(id_column), F.concat(*[_spans(k, F.col(f"items_{k.name}")) for k in KINDS]).alias("spans"))


def redact(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """``documents`` with each span of the text replaced by its kind, as ``[EMAIL]``. Kinds follow
    one another: account numbers first, then the base kinds, then the other added ones. A null
    text stays null."""
    others = [c for c in documents.columns if c != text_column]
    order = sorted(KINDS, key=lambda k: (k.name != "iban", not k.base))
    for kind in order:
        gaps, hits = _cut(kind, F.col(text_column))
        names = [f"{kind.name} {part} of {text_column}" for part in ("gaps", "hits")]
        while set(names) & set(others):
            names = [f"{n}_" for n in names]
        cut = documents.select(*others, gaps.alias(names[0]), hits.alias(names[1]))
        gaps, hits = F.col(f"`{names[0]}`"), F.col(f"`{names[1]}`")
        shown = F.array_join(F.transform(gaps, _shown(kind, gaps, hits)), "")
        documents = cut.select(*others, F.when(gaps[0].isNotNull(), shown).alias(text_column))
    return documents.select(*others, text_column)


def as_text(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data_query(spark, sf_dir: str) -> DataFrame:
    """Op 12: all spans of all documents; counts and digest of the base kinds."""
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(as_text(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def _words_sql(words: str) -> str:
    pattern = f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"
    return f"(regexp_matches(a, '{pattern}') OR regexp_matches(b, '{pattern}'))"


PERSONAL_DATA_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), kinds(kind, no, base, pattern) AS (VALUES
    ('email', 1, true, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
    ('ip', 2, true, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    ('card', 3, true, '[0-9]([\x20-]?[0-9])+'),
    ('phone', 4, true, '\+[0-9][\x20().0-9-]+[0-9]'),
    ('iban', 5, false, '[A-Z][A-Z][0-9][0-9](\x20?[A-Z0-9]){{11,30}}'),
    ('ssn', 6, false, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}'),
    ('local_phone', 7, false, '\(?[0-9]{{3}}\)?[\x20.-][0-9]{{3}}[\x20.-][0-9]{{4}}')
), cut AS (
    SELECT r, kind, no, base, regexp_extract_all(text, pattern) AS hits, regexp_split_to_array(text, pattern) AS gaps FROM docs, kinds
), each AS (
    SELECT r, kind, no, base, i, hits[i] AS hit, length(gaps[i]) AS gap, right(gaps[i], 40) AS before, left(gaps[i + 1], 20) AS after
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut)
), placed AS (
    SELECT *, sum(gap + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS stop, regexp_replace(hit, '[^0-9]', '', 'g') AS digits,
        replace(hit, ' ', '') AS compact,
        translate(before, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS a,
        translate(after, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b
    FROM each
), spans AS (
    SELECT r, kind, no, base, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop FROM placed
    WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR ('0' || right(p, 3))::INTEGER > 255)) = 0
        WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda k:
            CASE WHEN k % 2 = 0 THEN (2 * reverse(digits)[k]::INTEGER) % 10 + (2 * reverse(digits)[k]::INTEGER) // 10
            ELSE reverse(digits)[k]::INTEGER END)) % 10 = 0
        WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
        WHEN 'iban' THEN length(compact) BETWEEN 15 AND 34 AND NOT regexp_matches(before, '[A-Za-z0-9]$')
            AND NOT regexp_matches(after, '^[A-Za-z0-9]')
            AND list_reduce(list_prepend(0, list_transform(string_split(compact[5:] || compact[:4], ''), lambda c:
                CASE WHEN ascii(c) < 65 THEN ascii(c) - 48 ELSE ascii(c) + 945 END)), lambda x, y:
                CASE WHEN y < 10 THEN (x * 10 + y) % 97 ELSE (x * 100 + y - 1000) % 97 END) = 1
        WHEN 'ssn' THEN NOT regexp_matches(hit, '^(000|666|9)|-00-|-0000$') AND NOT regexp_matches(before, '[0-9-]$')
            AND NOT regexp_matches(after, '^[0-9-]') AND {_words_sql(SOCIAL_WORDS)} AND NOT {_words_sql(NUMBER_WORDS)}
        ELSE NOT regexp_matches(before, '[0-9+][\x20().-]*$') AND NOT regexp_matches(after, '^[\x20.-]?[0-9]')
            AND {_words_sql(PHONE_WORDS)} AND NOT {_words_sql(NUMBER_WORDS)}
        END
), joined AS (
    SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY no, start) FILTER (base), '') AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY no, start) AS spans
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""
