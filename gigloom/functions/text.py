"""Text normalisation as Column expressions. Nothing here leaves the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V

# fixed values: every whitespace character but the plain space
OTHER_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007" \
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = " " + OTHER_SPACES
# the same as a Java class, which is faster than naming the characters
RUNS = r"(?U)[\s\x1c-\x1f]+"
LINE_END = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def collapse(c) -> Column:
    """Whitespace runs become one space; ends stripped; null stays null."""
    return F.trim(F.regexp_replace(col(c), RUNS, " "))


def clean(c, zero_width: bool = True) -> Column:
    """Collapsed text with zero-width spaces removed; null becomes ''."""
    c = F.coalesce(col(c), F.lit(""))
    if zero_width:
        c = F.replace(c, F.lit("\u200b"), F.lit(""))
    return collapse(c)


def commas_to_spaces(c) -> Column:
    return strip(F.replace(col(c), F.lit(","), F.lit(" ")))


def _unless(c, test) -> Column:
    """The value where the test holds, else null; an expression is evaluated once."""
    if isinstance(c, str):
        return F.when(test(F.col(c)), F.col(c))
    return let(c, lambda x: F.when(test(x), x))


def nonblank(c) -> Column:
    """'' and all-whitespace become null."""
    return _unless(c, lambda x: strip(x) != "")


def nonempty(c) -> Column:
    return _unless(c, lambda x: x != "")


def not_missing(c) -> Column:
    """The 'NA' sentinel becomes null."""
    return _unless(c, lambda x: x != V.MISSING_TEXT)


def first_nonempty(*cols) -> Column:
    """First value that is neither null nor ''."""
    return F.coalesce(*[nonempty(c) for c in cols])


def no_nan(c) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(col(c)), col(c))


def first_of(c) -> Column:
    """First element of an array column, null when there is none."""
    return F.get(col(c), F.lit(0))


def drop_tags(c) -> Column:
    """Markup to one line of text using replacements only."""
    c = F.coalesce(col(c), F.lit(""))
    c = F.regexp_replace(c, r"(?iU)<br\s*/?>", "\n")
    c = F.regexp_replace(c, r"(?iU)</p\s*>", "\n\n")
    return clean(F.regexp_replace(c, r"<[^>]+>", " "))


def words(c) -> Column:
    """Number of whitespace-separated words; null counts as 0."""
    text = collapse(F.coalesce(col(c), F.lit("")))
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def _dashed(c, joint: str) -> Column:
    joined = F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", joint)
    return F.regexp_replace(joined, f"^{joint}+|{joint}+$", "")


def snake(c) -> Column:
    return _dashed(c, "_")


def code_name(company, platform) -> Column:
    return F.concat_ws("_", snake(company), snake(platform))


def slug(title, company, key) -> Column:
    """`<title>-at-<company>-<6 hex of the key>`; the suffix is a function of the row."""
    suffix = F.substring(F.md5(col(key).cast("string")), 1, 6)
    return F.concat(_dashed(title, "-"), F.lit("-at-"),
                    _dashed(F.coalesce(col(company), F.lit("unknown")), "-"), F.lit("-"), suffix)


def title_case(c) -> Column:
    """Upper-case after every character that is not a cased letter."""
    runs = F.regexp_extract_all(col(c), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_location(c) -> Column:
    t = F.lower(F.coalesce(col(c), F.lit("")))
    t = F.when(t == "nan", "").otherwise(t)
    t = F.regexp_replace(t, r"(?U)\.\.\+\s*\d+", "")
    t = F.regexp_replace(t, r"\(.*?\)", "")
    t = F.regexp_replace(t, r"(?U)\d+\/\d+|\d+\s*mw.*", "")
    t = F.regexp_replace(t, r"(?U)sector[-\s]*\d+[a-z]*", "")
    return collapse(t)


def shorten_location(c) -> Column:
    """More than three comma parts become first two distinct places and the last part."""
    c = col(c)

    def shortened(parts):
        last = F.element_at(parts, -1)
        # the country is dropped from the places only once, as places are distinct here
        places = F.array_remove(F.array_distinct(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))), last)
        return F.when(F.size(parts) > 3, F.concat(F.array_join(F.slice(places, 1, 2), ", "), F.lit(", "), last))

    parts = F.transform(F.split(c, ","), strip)
    return F.when(c.contains(";"), c).otherwise(F.coalesce(let(parts, shortened), c))


def first_answer_line(c) -> Column:
    """First line, cut at 'Example', without trailing '.', ':' or spaces."""
    line = F.substring_index(strip(c), "\n", 1)
    return F.regexp_replace(F.substring_index(line, "Example", 1), r"[.: ]+$", "")


def standard_location(c, remote_words=("remote",), resolved=None) -> Column:
    """Location label: remote / head-office shortcuts, else `resolved`, else title case."""
    def label(t):
        remote = F.lit(False)
        for w in remote_words:
            remote = remote | t.contains(w)
        named = title_case(t) if resolved is None else F.coalesce(
            nonempty(shorten_location(first_answer_line(resolved))), title_case(t))
        return (F.when(t == "", "").when(remote, "Remote")
                .when(t.contains("head office"), "Head Office").otherwise(named))

    return let(clean_location(c), label)


def first_line(c) -> Column:
    return strip(F.substring_index(col(c), "\n", 1))


def lines(c) -> Column:
    """Stripped non-empty lines of a text, using every Unicode line end."""
    unified = F.regexp_replace(col(c), LINE_END, "\n")
    return F.filter(F.transform(F.split(unified, "\n"), strip), lambda x: x != "")


def location_and_type(c) -> Column:
    """Multi-line cell: first line is the place, last line (of two or more) the job type."""
    return let(lines(c), lambda a: F.struct(
        F.get(a, F.lit(0)).alias("location"),
        F.when(F.size(a) >= 2, F.element_at(a, -1)).alias("job_type")))


def sections(c) -> Column:
    """Keep real '-' bullets under ROLE / REQUIREMENTS / BENEFITS; '' without ROLE bullets.

    The text is cut at heading lines, so work stays linear in its length however long it is.
    """
    headings = [h for hs in V.SECTION_HEADINGS.values() for h in hs]
    blank = r"[^\S\n]"
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), LINE_END, "\n")
    blocks = F.split(text, rf"(?imU)^(?={blank}*(?:{'|'.join(headings)}){blank}*$)")

    def titled(block):
        body = F.filter(F.transform(F.split(block, "\n"), strip), lambda x: x != "")
        return F.struct(F.upper(F.get(body, F.lit(0))).alias("head"), body.alias("body"))

    def real(line):
        low = F.lower(line)
        bad = F.lit(False)
        for p in V.PLACEHOLDERS:
            bad = bad | low.contains(p)
        return line.startswith("-") & ~bad

    def under(name, cut):
        mine = F.filter(cut, lambda b: b["head"].isin(V.SECTION_HEADINGS[name]))
        return F.filter(F.flatten(F.transform(mine, lambda b: b["body"])), real)

    def assembled(cut):
        def part(name):
            return let(under(name, cut), lambda b: F.when(
                F.size(b) > 0, F.concat(F.lit(name + "\n"), F.array_join(b, "\n"))))

        return let(F.array(*[part(name) for name in V.SECTION_HEADINGS]), lambda p: F.when(
            F.get(p, F.lit(0)).isNull(), "").otherwise(F.array_join(p, "\n\n")))

    return let(F.transform(blocks, titled), assembled)


def bullets_or_text(items, whole) -> Column:
    """List items joined by ' | ', or the whole text when there are none."""
    kept = F.filter(F.transform(items, lambda x: clean(x, False)), lambda x: x != "")
    return F.when(F.size(items) > 0, F.array_join(kept, " | ")).otherwise(clean(whole, False))


def titled_sections(*pairs) -> Column:
    """(heading, text) pairs with text, as 'heading\\ntext' joined by blank lines."""
    return nonempty(F.concat_ws("\n\n", *[
        F.when(nonempty(t).isNotNull(), F.concat(F.lit(h + "\n"), t)) for h, t in pairs]))


def plain_sections(*texts) -> Column:
    return nonempty(strip(F.concat_ws("\n\n", *[nonempty(t) for t in texts])))


def time_type(c) -> Column:
    return nonempty(F.trim(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?U)Time Type:\s*([A-Za-z ]+)", 1)))


def urls_in(c) -> Column:
    """Every http(s) URL in a text, in order."""
    return F.regexp_extract_all(col(c), F.lit(r"""(https?://[^\s\x1c-\x1f"'<>]+)"""), F.lit(1))
