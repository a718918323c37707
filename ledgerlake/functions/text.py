"""Notice text to tokens and shingles, as column expressions only."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Patterns, markers and words of the notice normalization. The
# flags make the JVM classes cover all Unicode letters and digits (U), ignore
# case (i, u) and end lines at \n only (d).
_FLAGS = "(?iuUd)"
MONEY = r"(?:rs\.?|inr|rupees)\s*[0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:lakh|cr|crore))?"
DATE = (
    r"\b(?:\d{1,2}[-/. ](?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[-/. ]\d{2,4}"
    r"|\d{4}[-/.]\d{1,2}[-/.]\d{1,2})\b"
)
REFERENCE = r"\b(?:npas|spc|pwd|ref|mc|tn)[-/a-z0-9]*\d[a-z0-9/-]*\b|\b\d{6,}\b"
BOILERPLATE = ("national procurement aggregation service", "state procurement cell")
BOILERPLATE_END = r"(?=name of work|tender|scope|$)"
CONTENT_MARKERS = ("name of work:", "tender reference number:", "scope of work")
DISCLAIMER = r"\n[-=]{10,}\nDisclaimer:"
WORD = "[a-z0-9]+"
TITLE_WEIGHT = 3


def words(text: Column) -> Column:
    """All lower-case ASCII words and numbers of already lower-cased text."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def tokens(text: Column) -> Column:
    return words(F.lower(text))


def normalize(text: Column) -> Column:
    """Tokens with amounts, dates and references as placeholders, boilerplate cut.

    The order counts: a date inside a reference is replaced before it.
    """
    text = F.lower(text)
    for pattern, name in ((MONEY, "money"), (DATE, "date"), (REFERENCE, "reference")):
        text = F.regexp_replace(text, _FLAGS + pattern, f" {name} ")
    for phrase in BOILERPLATE:
        text = F.regexp_replace(text, f"(?iuUds){phrase}.*?{BOILERPLATE_END}", " ")
    return words(text)


def content_start(body: Column, markers: Sequence[str] = CONTENT_MARKERS) -> Column:
    """1-based position of the first marker; 1 if there is none."""
    found = [F.nullif(F.locate(marker, F.lower(body)), F.lit(0)) for marker in markers]
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.coalesce(first, F.lit(1))


def content(body: Column, markers: Sequence[str] = CONTENT_MARKERS) -> Column:
    """The body from its first marker on, without the disclaimer."""
    start = content_start(body, markers)
    kept = F.substring(body, start, F.length(body))
    return F.split(kept, f"(?i){DISCLAIMER}", 2)[0]


def notice_tokens(
    title: Column,
    body: Column,
    markers: Sequence[str] = CONTENT_MARKERS,
    title_weight: int = TITLE_WEIGHT,
    tokenize=normalize,
) -> Column:
    """The title's tokens ``title_weight`` times, then the content's tokens."""
    heading = tokenize(title)
    return F.concat(*[heading] * title_weight, tokenize(content(body, markers)))


def shingles(token_list: Column, width: int) -> Column:
    """Distinct runs of ``width`` tokens; none if the text is shorter than that."""
    if width == 1:
        return F.array_distinct(token_list)
    starts = F.slice(token_list, 1, F.greatest(F.size(token_list) - (width - 1), F.lit(0)))

    def run(token, at):
        rest = [part for step in range(1, width)
                for part in (F.lit(" "), F.get(token_list, at + step))]
        return F.concat(token, *rest)

    return F.array_distinct(F.transform(starts, run))


def jaccard(common: Column, left: Column, right: Column) -> Column:
    """Jaccard similarity from set sizes; two empty sets are equal."""
    return F.coalesce(F.try_divide(common, left + right - common), F.lit(1.0))
