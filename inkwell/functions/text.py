"""Text metrics as Column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ALL_STOP_WORDS, MONTHS

#: The patterns of links, images and word breaks, and of the cleaning steps below with their order.
LINK = r"\[([^\]]+)\]\(([^)]+)\)"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
HTML_IMAGE = r"<img[^>]+>"
#: \w and one range; spelt out as ranges of letters and digits, Java takes some ten times as long.
BREAKS = r"[^\wА-я]+"


def round_half_up(x: Column, k: int) -> Column:
    """x rounded to 1/k, halves up (not away from zero)."""
    return F.floor(x * F.lit(float(k)) + 0.5) / F.lit(float(k))


def to_fixed(x: Column, digits: int = 2) -> Column:
    """x rounded by its exact binary value, ties away from zero: 1.005 to two places is 1.0, since it lies below 1.005.

    The product with the power of ten is kept with its rounding error, so that the comparison with a half is exact.
    """
    k = F.lit(float(10**digits))
    size = F.abs(x)
    p = size * k
    high = size * 134217729.0 - (size * 134217729.0 - size)
    error = (high * k - p) + (size - high) * k
    whole = F.floor(p)
    return F.signum(x) * (whole + F.when((p - whole - 0.5) + error >= 0, 1).otherwise(0)) / k


def _replace(text: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def strip_markdown(text: Column) -> Column:
    """Plain prose: marks go, blank lines become sentence ends. The order of the steps is part of the result."""
    plain = _replace(
        text, (IMAGE, ""), (HTML_IMAGE, ""), (LINK, "$1"), (r"https?:\/\/\S+", ""), (r"[#*`_~>|]", ""), (r"(?md)^-{3,}$", ""),
        (r"(?md)^\s*[-*+]\s+", ""), (r"(?md)^\s*\d+\.\s+", ""), (r"\n{2,}", ". "), (r"\s+", " "),
    )
    return F.trim(plain)


def light_clean(text: Column) -> Column:
    return _replace(text, (IMAGE, ""), (HTML_IMAGE, ""), (LINK, "$1"), (r"[#*`_]", ""), (r"\n\n+", ". "))


def structural_clean(text: Column, images_first: bool = False) -> Column:
    """Links to their texts and images away, in either order; links reach to a line's last parenthesis."""
    links, images = (r"\[([^\[]+)\](\(.*\))", "$1"), (r"!\[([^\[]*)\](\(.*\))", "")
    return _replace(F.trim(text), *((images, links) if images_first else (links, images)))


def keyword_clean(text: Column) -> Column:
    return _replace(text, (LINK, "$1"), (r"[#*`_]", ""), (r"[^\w\s]", " "))


def words(text: Column) -> Column:
    """Runs of Latin or Cyrillic letters, digits and underscores."""
    return F.array_remove(F.split(text, BREAKS), "")


def distinct_tokens(text: Column, stop: tuple[str, ...] = ALL_STOP_WORDS) -> Column:
    """Distinct lower-case words of the stripped text, longer than two characters and no stop words."""
    listed = F.array(*map(F.lit, stop))
    return F.array_except(F.filter(words(F.lower(strip_markdown(text))), lambda w: F.length(w) > 2), listed)


def sentences(text: Column) -> Column:
    return F.array_remove(F.transform(F.split(text, r"[.!?]+"), lambda s: F.trim(s)), "")


def spaced_words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def bigrams(listed: Column) -> Column:
    """Neighbouring words joined by a space; both sides are slices, so that the list is not computed anew for each pair."""
    n = F.greatest(F.size(listed) - 1, F.lit(0))
    return F.zip_with(F.slice(listed, F.lit(1), n), F.slice(listed, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def syllables(word: Column) -> Column:
    low = F.lower(word)
    stem = _replace(low, (r"(?:[^laeiouy]es|ed|[^laeiouy]e)$", ""), (r"^y", ""))
    return F.when(F.length(low) <= 3, 1).otherwise(F.greatest(F.regexp_count(stem, F.lit("[aeiouy]{1,2}")), F.lit(1)))


def text_syllables(text: Column) -> Column:
    """The sum of syllables over a text's words between white space, by patterns over the whole text: short words and such
    without a vowel become one vowel, endings go, a leading y becomes a mark, and the vowel groups left are counted."""
    plain = _replace(F.lower(text), (r"\s+", " "), (r"(?<![^ ])[^ ]{1,3}(?![^ ])", "a"), (r"(?:[^laeiouy ]es|ed|[^laeiouy ]e)(?![^ ])", ""), (r"(?<![^ ])y", "-"), (r"(?<![^ ])[^aeiouy ]+(?![^ ])", "a"))
    return F.regexp_count(plain, F.lit("[aeiouy]{1,2}"))


def reading_grade(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    grade = 0.39 * (n_words / n_sentences) + 11.8 * (n_syllables / n_words) - 15.59
    return F.when((n_words == 0) | (n_sentences == 0), 0.0).otherwise(grade)


def question_density(text: Column) -> Column:
    """Share of sentences, cut behind their marks, that end in a question mark."""
    cut = F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != "")
    return F.coalesce(F.try_divide(F.size(F.filter(cut, lambda s: s.endswith("?"))), F.size(cut)), F.lit(0.0))


def list_ratio(markdown: Column) -> Column:
    lines = F.filter(F.split(markdown, "\n"), lambda x: F.trim(x) != "")
    return F.coalesce(F.try_divide(F.size(F.filter(lines, lambda x: x.rlike(r"^\s*([-*+]|\d+\.)\s"))), F.size(lines)), F.lit(0.0))


def opening_line(markdown: Column) -> Column:
    lines = F.transform(F.split(markdown, "\n"), lambda x: F.trim(x))
    good = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^(#|-{3,}|!\[|<img)"))
    return F.coalesce(F.substring(F.regexp_replace(F.try_element_at(good, F.lit(1)), LINK, "$1"), 1, 200), F.lit(""))


def links(text: Column) -> Column:
    """Array of (text, url); images with a text count as links too."""
    return F.arrays_zip(F.regexp_extract_all(text, F.lit(LINK), 1).alias("text"), F.regexp_extract_all(text, F.lit(LINK), 2).alias("url"))


def image_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(IMAGE)) + F.regexp_count(text, F.lit(HTML_IMAGE))


def headings(text: Column) -> Column:
    pattern = F.lit(r"(?md)^(#{1,6})\s+(.+)$")
    level = F.transform(F.regexp_extract_all(text, pattern, 1), lambda x: F.length(x))
    return F.arrays_zip(level.alias("level"), F.transform(F.regexp_extract_all(text, pattern, 2), lambda x: F.trim(x)).alias("text"))


def paragraph_count(text: Column) -> Column:
    return F.size(F.split(text, "\n\n"))


def month_number(name: Column) -> Column:
    """1 to 12 for a full month name in any case, else null."""
    return F.element_at(F.create_map(*(F.lit(x) for k, m in enumerate(MONTHS, 1) for x in (m, k))), F.lower(name))


def date_from_filename(name: Column) -> Column:
    """yyyy-MM-01 of month-year names; a name that goes on behind the month (junejuly) counts as that month."""
    token, year = (F.regexp_extract(name, r"(?i)^([a-z]+)-(\d{4}).*\.md$", k) for k in (1, 2))
    month = month_number(F.regexp_extract(F.lower(token), f"^({'|'.join(MONTHS)})", 1))
    return F.when((year != "") & month.isNotNull(), F.concat_ws("-", year, F.format_string("%02d", month), F.lit("01")))


def exact_month_year(name: Column) -> Column:
    """The archive's folder of a name: its first two parts must be a month and four digits."""
    part = F.split(name, "-")
    return F.when(F.get(part, F.lit(1)).rlike(r"^\d{4}"), F.struct(F.substring(F.get(part, F.lit(1)), 1, 4).alias("year"), month_number(F.get(part, F.lit(0))).alias("month")))


def last_month(text: Column) -> Column:
    """The month named last in a text."""
    return month_number(F.nullif(F.regexp_extract(F.lower(text), f"(?s).*({'|'.join(MONTHS)})", 1), F.lit("")))


def coverage_date(base: Column, subject: Column, filename: Column) -> Column:
    """The first day of the month that a post covers: the month from subject, file name or base date, the year from the base date."""
    month = F.coalesce(last_month(subject), last_month(filename), F.month(base))
    return F.make_date(F.year(base), month, F.lit(1))


def coverage_month(base: Column, title: Column, slug: Column) -> Column:
    """yyyy-MM: the month from title, slug or base date, the year always from the base date."""
    return F.concat_ws("-", F.year(base), F.format_string("%02d", F.coalesce(last_month(title), last_month(slug), F.month(base))))


def days_late(posted: Column, coverage: Column) -> Column:
    """Days from the end of the month covered to the posting, rounded half up."""
    gap = F.unix_timestamp(posted.cast("timestamp")) - F.unix_timestamp(F.last_day(coverage).cast("timestamp"))
    return F.floor(gap / 86400 + 0.5).cast("long")


def slug(url: Column) -> Column:
    """What follows /p/, else the last part of a URL's path."""
    clean = F.regexp_replace(url, r"[?#].*$", "")
    return F.coalesce(F.nullif(F.regexp_extract(clean, r"/p/([^/]+)", 1), F.lit("")), F.element_at(F.split(F.regexp_replace(clean, "/+$", ""), "/"), -1))


def safe_slug(url: Column) -> Column:
    return F.regexp_replace(slug(url), r"[^A-Za-z0-9_-]", "-")


def padded(number: Column, width: int = 3) -> Column:
    return F.format_string(f"%0{width}d", number)
