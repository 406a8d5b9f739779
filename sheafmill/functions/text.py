"""Text rules as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill import fixed

_RARE_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove every Unicode whitespace character from both ends (SQL trim takes only spaces)."""
    return F.btrim(col(c), F.lit(fixed.STRIP_CHARS))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def text_or_unknown(c: Column | str) -> Column:
    return F.when(text_or_empty(c) == "", F.lit("unknown")).otherwise(col(c))


def _lower_hex(c: Column, digit: str) -> Column:
    """Write one hex digit of control-character escapes in lower case, outside escaped backslashes."""
    found = rf"(?<!\\)((?:\\\\)*)\\u00([01]){digit}"
    return F.regexp_replace(c, F.lit(found), F.lit(rf"$1\\u00$2{digit.lower()}"))


def json_string(c: Column | str) -> Column:
    """A JSON string literal: quotes, backslashes and control characters escaped, all else kept.

    Few texts hold a control character beyond tab and line ends, so five plain replacements do
    for nearly all; the others go through to_json, whose hex digits are upper case.
    """
    c = col(c)
    plain = c
    for char, escape in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(char), F.lit(escape))
    whole = F.to_json(F.struct(c.alias("v")))
    literal = F.substring(whole, F.lit(6), F.length(whole) - 6)
    for digit in "ABCDEF":
        literal = _lower_hex(literal, digit)
    return F.when(c.rlike(_RARE_CONTROL), literal).otherwise(F.concat(F.lit('"'), plain, F.lit('"')))


def _is_removed(body: Column) -> Column:
    return body.isin(*fixed.REMOVED_BODIES)


def json_document(title: Column | str, body: Column | str) -> Column:
    """The structured document of stripped, non-null fields; '' when there is nothing to say.

    Without a usable body the title is the text, and then it is not named as a title.
    """
    title, body = col(title), col(body)
    no_body = _is_removed(body) | (body == "")
    head = F.when(no_body | (title == ""), F.lit("")).otherwise(
        F.concat(F.lit(f'"{fixed.TITLE_FIELD}": '), json_string(title), F.lit(", "))
    )
    text = F.when(no_body, title).otherwise(body)
    document = F.concat(
        F.lit("{"), head, F.lit(f'"{fixed.BODY_FIELD}": '), json_string(text), F.lit("}")
    )
    return F.when(text == "", F.lit("")).otherwise(document)


def plain_document(title: Column | str, body: Column | str) -> Column:
    """Title and body on separate lines; a removed body leaves the title alone."""
    title, body = col(title), col(body)
    return F.when(_is_removed(body), title).otherwise(
        F.concat_ws("\n", F.nullif(title, F.lit("")), F.nullif(body, F.lit("")))
    )


def joined_key(title: Column | str, body: Column | str) -> Column:
    """The concatenated duplicate key, which can collide; keep it for matching old corpora."""
    return F.concat(text_or_empty(title), F.lit(fixed.KEY_SEPARATOR), text_or_empty(body))


def shuffle_key(key: Column | str, seed: int = fixed.SEED) -> Column:
    """A reproducible pseudo-random order: sort by it instead of drawing random numbers."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key)).cast("binary"))


def cut(c: Column | str, limit: int, keep: int, mark: str) -> Column:
    """Text longer than `limit` becomes its first `keep` characters and a mark."""
    c = col(c)
    return F.when(F.char_length(c) > limit, F.concat(F.left(c, F.lit(keep)), F.lit(mark))).otherwise(c)


def sample_text(c: Column | str) -> Column:
    return cut(c, fixed.SAMPLE_CHARS, fixed.SAMPLE_CHARS, fixed.SAMPLE_MARK)


def chart_label(c: Column | str) -> Column:
    return cut(strip(text_or_empty(c)), fixed.LABEL_CHARS, fixed.LABEL_KEEP, fixed.LABEL_MARK)


def number(c: Column | str) -> Column:
    """A double, or NULL when the text is no number; NaN counts as missing.

    The spelling is tested first: a cast alone would take `1.5f` and `2d` as numbers.
    """
    text = strip(col(c).cast("string"))
    spelled = text.rlike(r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)$")
    return F.when(spelled, text.try_cast("double"))


def status_label(c: Column | str) -> Column:
    return F.upper(strip(c))


def percent_text(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def bar_text(share: Column) -> Column:
    return F.repeat(F.lit("█"), F.floor(share * 50).cast("int"))


def bits_per_byte(nats: Column, nbytes: Column) -> Column:
    """Total nats over total bytes, as bits; NULL when no byte was scored."""
    return F.try_divide(nats, nbytes * F.log(F.lit(2.0)))


def gigabytes(mb: Column | str) -> Column:
    return F.round(col(mb) / 1024, 1)


def display_bytes(token: Column | str) -> Column:
    """UTF-8 length of a token decoded alone: each malformed part counts as one U+FFFD."""
    return F.octet_length(F.make_valid_utf8(col(token).cast("string")))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns that are costly and used more than once.

    A filter on a computed column is pushed below the projection with a copy of its expression,
    so a long text rule would run for the filter and again for its result. A one-row generator
    stops that and stays inside generated code.
    """
    kept = [c for c in df.columns if c not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))
