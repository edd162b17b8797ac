"""Ordered rules and keyword classifiers."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions.text import clean, col, collapse, let, nonempty, strip


def first_match(c, rules, default=None) -> Column:
    """Label of the first (pattern, label) rule found in the text."""
    c = strip(F.lower(col(c)))
    out = None
    for pattern, label in rules:
        hit = c.rlike(f"(?iU){pattern}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out if default is None else out.otherwise(default)


def any_word(c, words) -> Column:
    """True when any of the words or phrases occurs whole, in any case."""
    either = "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)
    return F.coalesce(col(c).rlike(rf"(?iU)\b(?:{either})\b"), F.lit(False))


def is_green_title(c) -> Column:
    return any_word(c, V.TITLE_WORDS)


def contains_any(c, parts) -> Column:
    low = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.lit(False)
    for p in parts:
        hit = hit | low.contains(p)
    return hit


def mentions(word: str, *cols) -> Column:
    """True when any of the columns holds the word, in any case."""
    return F.lower(F.concat_ws(" ", *cols)).contains(word.lower())


def on_platform(c) -> Column:
    return contains_any(c, V.PLATFORM_HOSTS)


def is_job_link(href, text=None) -> Column:
    hit = contains_any(href, V.JOB_LINK_WORDS)
    return hit if text is None else hit | contains_any(text, V.JOB_LINK_WORDS)


def page_score(c) -> Column:
    low = F.lower(F.coalesce(col(c), F.lit("")))
    score = F.when(low.contains("jobposting"), 2).otherwise(0)
    for hint in V.PAGE_HINTS:
        score = score + F.when(low.contains(hint), 1).otherwise(0)
    return score


def careers_verdict(url, score, text_length, job_links, platform_links) -> Column:
    """struct<confidence, reason>: highest confidence, but the last rule's reason."""
    url, score, text_length = col(url), col(score), col(text_length)
    rules = [
        (col(platform_links) > 0, 0.9, "links-to-ats"),
        (col(job_links) >= 5, 0.8, "many-jobish-links"),
        ((score >= 3) & (text_length > 500), 0.75, "content-hints"),
        (is_job_link(url), 0.7, "url-hint"),
    ]
    best = F.greatest(F.lit(0.0), *[F.when(test, value).otherwise(0.0) for test, value, _ in rules])
    why = F.coalesce(*[F.when(test, F.lit(name)) for test, _, name in reversed(rules)], F.lit("low"))
    hosted = on_platform(url)
    return F.struct(F.when(hosted, 0.95).otherwise(best).alias("confidence"),
                    F.when(hosted, "ats-url").otherwise(why).alias("reason"))


def platform_of(c) -> Column:
    """struct<ats_name, ats_url> of the first platform rule that reads the address, else null."""
    def rule(url, low, name, hosts, pattern, address):
        pattern = f"(?iU){pattern}"
        known = F.lit(False)
        for h in hosts:
            known = known | low.contains(h)
        before, *middle, after = address.split("{}")
        one = nonempty(F.regexp_extract(url, pattern, 1))
        if middle:
            built = F.concat(F.lit(before), one, F.lit(middle[0]), F.regexp_extract(url, pattern, 2), F.lit(after))
        else:
            # a pattern with two alternatives carries the name in whichever group matched
            if re.compile(pattern.replace("(?iU)", "")).groups > 1:
                one = F.coalesce(one, nonempty(F.regexp_extract(url, pattern, 2)))
            built = F.concat(F.lit(before), one, F.lit(after))
        return F.when(known & built.isNotNull(), F.struct(F.lit(name).alias("ats_name"), built.alias("ats_url")))

    return let(col(c), lambda url: F.coalesce(*[rule(url, F.lower(url), *r) for r in V.PLATFORM_RULES]))


def job_type(c, titled: bool = False, underscores: bool = False, slashes: bool = False) -> Column:
    """Known job types get one spelling; anything else is kept as cleaned text."""
    table = V.JOB_TYPES_TITLED if titled else V.JOB_TYPES
    text = strip(col(c)) if titled else clean(c)
    key = clean(c)
    if slashes:
        text = key = strip(F.replace(key, F.lit("/"), F.lit("")))
    key = F.lower(key)
    if underscores:
        key = F.trim(F.replace(key, F.lit("_"), F.lit(" ")))
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    blank = F.coalesce(col(c), F.lit("")) == ""
    if titled:
        blank = blank | (col(c) == V.MISSING_TEXT)
    return F.when(~blank, nonempty(F.coalesce(F.try_element_at(known, key), text)))


def employment_class(c) -> Column:
    """Internship, Contractor or Full Time, by substring."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    return (F.when(low.contains("intern"), "Internship")
            .when(contains_any(c, V.CONTRACTOR_WORDS), "Contractor").otherwise("Full Time"))


def in_india(c) -> Column:
    """Place-token gate: 'India' or plain 'Remote' passes, and a place whose last part is an Indian one.

    Parts stand between commas, slashes and the like. 'Kota Kinabalu' is not Kota, and in 'Agra,
    Kansas' the last part decides; a place that is not listed does not pass.
    """
    places = "|".join(re.sub(r"([^\w\s])", r"\\\1", p) for p in V.INDIA_PLACES)
    t = collapse(F.lower(F.coalesce(col(c), F.lit(""))))
    bare = F.regexp_replace(t, r"(?U)\b(?:" + "|".join(V.PLACE_FILLERS) + r")\b", " ")
    parts = F.filter(F.transform(F.split(bare, r"[,/|;()]+| - "), strip), lambda p: p != "")
    last = F.try_element_at(parts, F.lit(-1))
    return (t != "") & (t.rlike(r"(?U)\b(?:india|bharat)\b") | t.rlike(r"^(?:fully |100% )?remote$")
                        | F.coalesce(last.rlike(rf"(?U)^(?:{places})(?:[\s&+.-]+(?:{places}))*$"), F.lit(False)))


def country_gate(c, wanted: str = "IN") -> Column:
    return F.coalesce(F.upper(col(c)), F.lit("")).isin("", wanted)
