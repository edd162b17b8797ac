"""HTML extraction by wrapper induction: union-free regular expressions inferred from same-host pages.

A page is a stream of block tags and texts. Reading it, neighbouring elements of one kind (and
neighbouring runs of two or three kinds) become a repeated group. Aligning a page with its
host's wrapper, elements that one of them lacks become optional, and texts that differ become
slots. Alignment is repeated page after page within a task, and wrapper with wrapper across
tasks, so a host's wrapper is one expression over all its pages, such as
    <body>(<nav>(<a>#</a>)+</nav>)?<article><h1>#</h1>(<p>#</p>)+</article></body>

The wrapper tells where the main text is: its article elements, else its main element, else
the element that holds most slot text. It decides three things more. Texts equal on all pages
are part of the template (of three pages with different texts or more; a text in an optional
element never is), in articles and among repeated texts only those of SENTENCE words or over 60
characters, and no headings of articles. Articles that all pages have don't count where four times
as much text stands beside them, repeated groups other than paragraphs left out: they are
teasers. Elements for navigation, adverts, forms and the like have no part in the main text, but
a form, a header or an element with a mere layout name ("content-banner-wrapper") that holds four
fifths of a host's text and all of its articles is no furniture there.

Class names that one page alone has are generated ones: where a level of a wrapper has more than
FEW such elements of a tag, or MANY optional ones, they become one element of any class
("div*"), so a wrapper's size doesn't grow with the pages.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored
from gigloom.llm.words import pieces

DEPTH = 128  # deeper elements count as text of their ancestor at this depth
SENTENCE = 4  # words of a text that is taken for template within an article or among others
FEW, MANY = 8, 64  # elements of one tag that one page alone has, and optional ones, which a level holds apart
ALIGN = 250_000  # cells of an exact alignment; longer sequences are aligned greedily
HOSTS = 2000  # wrappers that a task holds before it hands them on
RULE_BYTES = 32 << 20  # rules of all hosts that are broadcast

# Element and attribute names of HTML and of common page furniture.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span "
             "strike strong sub sup time tt u var wbr".split())
VOID = set("area base basefont br col embed frame hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
FURNITURE = set("aside button canvas datalist dialog footer form head header iframe input menu nav noembed noframes noscript object "
                "option script select style svg template textarea title xmp".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
            "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
NOISE = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
            "disclaimer disqus feedback footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager "
            "pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social "
            "sponsor sponsored subscribe subscription teaser teasers toolbar widget".split())
# Words that a name may have besides those of NOISE and still be one of furniture: "comment-list", "left-sidebar", not "related-work".
PARTS = set("area bar block body bottom box btn button buttons center col column container content desktop fixed float global group header heading icon "
            "icons inner inline item items js left links list lists main media mobile module outer overlay page panel post posts primary right row "
            "secondary section site slot small sticky tag text title top unit widget widgets wrap wrapper".split())
PROSE = INLINE | set("h1 h2 h3 h4 h5 h6 p blockquote pre".split())  # a name of one of these tells of its words, not of the page
QUALIFIERS = set("has have hide is js no not show with without".split())  # "has-sidebar" names a page's layout, not a sidebar
# These may name what holds the text, too.
LAYOUT = set("banner feedback header masthead promo promoted promotion recommended social teaser teasers toolbar widget".split())
OPEN = set("form header".split())  # elements that may
ARTICLE_NOISE = set("ad ads advert comment comments promo promoted recommended related replies reply sponsored teaser teasers".split())
NOISE_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
LEAF = set("p h1 h2 h3 h4 h5 h6 li td th dd dt blockquote pre figcaption".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S)
_ATTR = re.compile(r"(?<![^\s\"'])(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SECTION = re.compile(r"\bclass\s*=\s*(?:\"[^\"]*\bsection\b|'[^']*\bsection\b|section\b)", re.I)
_HEADING = re.compile(r"/h[1-6](?![a-z0-9])[^/]*\Z")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _label(tag: str, attributes: str, in_article: bool = False) -> tuple[str, int]:
    """(name in the wrapper, 2 for page furniture, 1 for what may be, 0 for others) of a start tag. An article's own header is no furniture."""
    own = tag == "header" and in_article
    noise, kinds = 0 if own or tag not in FURNITURE else 1 if tag in OPEN else 2, ""
    headed = tag == "section" or bool(attributes) and _SECTION.search(attributes) is not None  # its id is made of its heading
    if attributes and tag not in ("html", "body"):
        for m in _ATTR.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                known = ARTICLE_NOISE if tag in ("article", "main") else NOISE - {"header", "masthead"} if own else NOISE
                for one in value.split() if tag not in PROSE and not (headed and name == "id") else ():
                    words = [w.lower() for w in _PART.findall(one) if not w.isdigit()]
                    if words and words[0] not in QUALIFIERS and not known.isdisjoint(words) and PARTS.union(NOISE).issuperset(words):
                        noise = max(noise, 1 if tag not in ("article", "main") and LAYOUT.issuperset(known.intersection(words)) else 2)
                if name == "class":
                    kinds += "." + ".".join(sorted({re.sub(r"\d+", "0", w).replace("/", "|") for w in value.split()}))
            elif name == "role":
                noise = max(noise, (1 if value.lower() in ("banner", "form") else 2) if value.lower() in NOISE_ROLES else 0)
                kinds += "@main" if value.lower() == "main" else ""
            elif name == "hidden" or value.lower() == "true":
                noise = 2
    return tag + kinds + "!" * noise, noise


def _tag(label: str) -> str:
    return re.split(r"[.@*!]", label, maxsplit=1)[0]


def _wide(label: str) -> str:
    """The label of elements of this tag with any class names."""
    base = label.rstrip("!")
    return f"{_tag(base)}{'@main' * ('@main' in base)}*{label[len(base):]}" if "." in base else label


def read(html: str) -> Iterator[tuple[str, str, int]]:
    """Events of a page: ("open", label, furniture), ("close", "", 0), ("break", "", 0) and ("text", text, furniture).

    Furniture is an element's own, as `_label` has it; a text's is that of the inline elements around it.

    Never fails and takes time in proportion to the page: end tags without a start tag are
    passed over by a count of open tags, unclosed elements end with their parents.
    """
    stack: list[tuple[str, int, bool]] = []  # tag, furniture of the inline elements up to it, whether an event was sent
    count: dict[str, int] = {}
    at, size = 0, len(html)

    def pop():
        tag, _, sent = stack.pop()
        count[tag] -= 1
        return [("close", "", 0)] if sent else []

    while at < size:
        m = _TAG.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text:
            yield "text", text, stack[-1][1] if stack else 0
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        if m[1] or m[0].startswith("</"):
            if count.get(tag):
                while True:
                    done = stack[-1][0] == tag
                    yield from pop()
                    if done:
                        break
            elif tag == "p" or tag not in INLINE:
                yield "break", "", 0
            continue
        if tag == "body":
            while stack and stack[-1][0] != "html":
                yield from pop()
        elif tag in ENDS_P and count.get("p"):
            # an open paragraph ends, unless it is outside the innermost block
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if k >= 0 and stack[k][0] == "p":
                while len(stack) > k:
                    yield from pop()
        elif tag in SIBLINGS:
            ends, parents = SIBLINGS[tag]
            names = ends.split()
            if any(count.get(x) for x in names):
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in names and stack[k][0] not in parents and (stack[k][0] in INLINE or stack[k][0] == "p"):
                    k -= 1
                if k >= 0 and stack[k][0] in names:
                    if tag == "tr" and stack[k][0] != "tr" and k and stack[k - 1][0] == "tr":
                        k -= 1
                    while len(stack) > k:
                        yield from pop()
        label, noise = _label(tag, m[3] or "", count.get("article", 0) > 0)
        if tag in VOID:
            if tag == "br":
                yield "text", " ", stack[-1][1] if stack else 0
            elif tag == "hr":
                yield "break", "", 0
            continue
        block = tag not in INLINE
        stack.append((tag, 0 if block else max(noise, stack[-1][1] if stack else 0), block))
        count[tag] = count.get(tag, 0) + 1
        if block:
            yield "open", label, noise
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            if not end:
                break
            at = end.start()
    while stack:
        yield from pop()


# A node of an expression: [label, repeated, optional, furniture, characters, the one text or None, children, whether one page alone has it]
# A text slot has one entry more, the texts that all pages have there. It has the label "#", a group of several kinds the label "()".


def _same(text: str) -> str:
    """What stands for a text when texts are compared: itself, or a digest of a long one."""
    return text if len(text) <= 60 else "=" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=12).hexdigest()


def _sentence(same: str) -> bool:
    return len(same) > 60 or same.startswith("=") and len(same) == 25 or len(same.split()) >= SENTENCE


def _slot(text: str) -> list:
    return ["#", False, False, 0, len(text), _same(text), [], True, [_same(text)]]


def expression(html: str) -> list:
    """The expression of one page, repeated groups folded."""
    top: list = []
    open_: list = [top]
    depth, words = 0, []

    def flush():
        text = " ".join(unescape("".join(words)).split())
        words.clear()
        if text:
            open_[-1].append(_slot(text))

    for kind, value, noise in read(html):
        if kind == "text":
            if not noise:
                words.append(value)
            continue
        if kind == "open":
            depth += 1
            if depth > DEPTH:
                words.append(" ")
                continue
            flush()
            node = [value, False, False, noise, 0, None, [], True]
            open_[-1].append(node)
            open_.append(node[6])
        elif kind == "close":
            depth -= 1
            if depth >= DEPTH:
                words.append(" ")
                continue
            flush()
            kids = open_.pop()
            kids[:] = folded(kids)
        else:
            flush()
    flush()
    return folded(top)


def folded(kids: list) -> list:
    """Neighbours of one kind as one repeated node, then neighbouring equal runs of two or three kinds as a repeated group."""
    out: list = []
    for node in kids:
        if out and out[-1][0] == node[0]:
            out[-1] = _joined(out[-1], node, True)
            out[-1][1] = True
        else:
            out.append(node)
    for period in (2, 3):
        i = 0
        while i + 2 * period <= len(out):
            names = [x[0] for x in out[i:i + period]]
            j = i + period
            while [x[0] for x in out[j:j + period]] == names:
                j += period
            if j > i + period:
                group = out[i:i + period]
                for k in range(i + period, j, period):
                    group = [_joined(a, b, True) for a, b in zip(group, out[k:k + period])]
                out[i:j] = [["()", True, False, 0, 0, None, group, True]]
            i += 1
    return out


def _joined(a: list, b: list, alone: bool = False) -> list:
    """One node for two that were aligned; alone: both are of one page."""
    once = alone and a[7] and b[7]
    if a[0] == "#":
        common = sorted({*a[8], *b[8]} if alone else {*a[8]}.intersection(b[8]))
        return ["#", a[1] or b[1], a[2] or b[2], 0, a[4] + b[4], a[5] if a[5] == b[5] else None, [], once, common]
    return [a[0] if a[0] == b[0] else _wide(a[0]), a[1] or b[1], a[2] or b[2], a[3], 0, None, aligned(a[6], b[6], alone), once]


def aligned(a: list, b: list, alone: bool = False) -> list:
    """Two sequences as one: common elements joined, others optional, in an order that keeps both."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_joined(x, y, alone) for x, y in zip(a, b)]
    names, others = {x[0] for x in a}, {x[0] for x in b}
    out, i, j = [], 0, 0
    for x, y in _common([_among(n[0], others) for n in a], [_among(n[0], names) for n in b]):
        out += [_optional(n) for n in a[i:x]] + [_optional(n) for n in b[j:y]] + [_joined(a[x], b[y], alone)]
        i, j = x + 1, y + 1
    return _generalised(out + [_optional(n) for n in a[i:]] + [_optional(n) for n in b[j:]])


def _among(label: str, others: set[str]) -> str:
    """What a label is compared as: the one of any class if the other side has only that."""
    return _wide(label) if label not in others and _wide(label) in others else label


def _generalised(level: list) -> list:
    """A level where tags with more than FEW elements that one page alone has, or MANY optional ones, have one element of any class for these."""
    optional: dict[str, list[int]] = {}
    for k, node in enumerate(level):
        if node[2] and "." in node[0]:
            optional.setdefault(_wide(node[0]), []).append(k)
    for name, places in optional.items():
        once = [k for k in places if level[k][7]]
        places = places if len(places) > MANY else once if len(once) > FEW else []
        if not places:
            continue
        own = next((k for k, node in enumerate(level) if node and node[0] == name), None)
        first = places[0] if own is None else own
        node = level[first]
        for k in places:
            if k != first:
                node = _joined(node, level[k])
                level[k] = None
        level[first] = [name, True, True, *node[3:7], False]
    return [node for node in level if node]


def _optional(node: list) -> list:
    return [node[0], node[1], True, *node[3:]]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence (a greedy one beyond ALIGN cells)."""
    if len(a) * len(b) > ALIGN:
        where: dict[str, list[int]] = {}
        for j, name in enumerate(b):
            where.setdefault(name, []).append(j)
        out, last = [], -1
        used = dict.fromkeys(where, 0)
        for i, name in enumerate(a):
            spots = where.get(name, [])
            while used.get(name, 0) < len(spots) and spots[used[name]] <= last:
                used[name] += 1
            if used.get(name, 0) < len(spots):
                last = spots[used[name]]
                out.append((i, last))
        return out
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def written(nodes: list) -> str:
    """A wrapper as a regular expression over tags; # is a text slot, a constant text stands in quotes."""
    out = ""
    for label, many, optional, _, _, text, kids, *_ in nodes:
        label = label.rstrip("!")
        if label == "#":
            body = "#" if text is None else json.dumps(text, ensure_ascii=False)
        else:
            body = written(kids) if label == "()" else f"<{label}>{written(kids)}</{_tag(label)}>"
        mark = {(False, False): "", (True, False): "+", (False, True): "?", (True, True): "*"}[many, optional]
        out += f"({body}){mark}" if mark else body
    return out


def _walk(nodes: list, path: str = "", optional: bool = False):
    """(path, node, whether pages lack it) of all nodes that aren't furniture, groups passed through."""
    for node in nodes:
        if node[3]:
            continue
        here, some = path if node[0] == "()" else f"{path}/{node[0]}", optional or node[2]
        if node[0] != "()":
            yield here, node, some
        yield from _walk(node[6], here, some)


def _constant(nodes: list, path: str = ""):
    """(path, text) of the texts that are equal on all pages: neither they nor an ancestor is optional."""
    for node in nodes:
        if node[3] or node[2]:
            continue
        if node[0] == "#":
            yield from ((path, text) for text in node[8] if text == node[5] or _sentence(text))
        yield from _constant(node[6], path if node[0] == "()" else f"{path}/{node[0]}")


def _chars(node: list, optional: bool = False) -> int:
    """Characters of a node's text that isn't template."""
    optional |= node[2]
    return 0 if node[3] else (node[4] if node[5] is None or optional else 0) + sum(_chars(x, optional) for x in node[6])


def _size(node: list, least: int = 1, single: bool = False) -> int:
    """Characters of all text outside furniture of this degree; single: outside repeated elements other than prose too."""
    if node[3] >= least or single and node[1] and node[0] != "#" and _tag(node[0]) not in PROSE:
        return 0
    return node[4] + sum(_size(x, least, single) for x in node[6])


def _kind(label: str) -> str | None:
    return "article" if _tag(label) == "article" else "main" if _tag(label) == "main" or "@main" in label else None


def _prose(nodes: list) -> bool:
    """Whether a paragraph, heading or article stands in these nodes, furniture that can't hold the text left out."""
    return any(x[3] < 2 and (_tag(x[0]) in LEAF or _kind(x[0]) is not None or _prose(x[6])) for x in nodes)


def _freed(nodes: list, total: int, path: str, found: list[str]) -> list:
    """Nodes in which an element that holds four fifths of the text isn't furniture; the paths of such elements are added to `found`."""
    out = []
    for node in nodes:
        size = _size(node, 2)
        if size and 5 * size >= 4 * total:
            here = path if node[0] == "()" else f"{path}/{node[0]}"
            if node[3] == 0 or node[3] == 1 and _prose(node[6]):
                if node[3]:
                    found.append(here)
                node = [*node[:3], 0, *node[4:6], _freed(node[6], total, here, found), *node[7:]]
        out.append(node)
    return out


def rule(wrapper: list, pages: int) -> dict:
    """Where the main text is: paths of article elements, of main elements, of the element with most slot text, and of what is freed.

    pages: how many pages with different texts the wrapper is of.
    """
    free: list[str] = []
    if not any(_kind(node[0]) for _, node, _ in _walk(wrapper)):
        wrapper = _freed(wrapper, sum(_size(x, 2) for x in wrapper), "", free)
    found: dict[str, dict[str, list]] = {"article": {}, "main": {}}
    for path, node, some in _walk(wrapper):
        kind = _kind(node[0])
        if kind and not any(path.startswith(f"{p}/") for p in found[kind]):
            found[kind].setdefault(path, []).append((node, some))
    always = [x for nodes in found["article"].values() for x, some in nodes if not some]
    if always:
        inside = sum(_size(x) for nodes in found["article"].values() for x, _ in nodes)
        if 4 * inside < sum(_size(x, 1, True) for x in wrapper) - sum(_size(x, 1, True) for nodes in found["article"].values() for x, _ in nodes):
            found["article"] = {}
    path, level, optional = "", wrapper, False
    constants = sorted(set(_constant(wrapper))) if pages > 2 and sum(map(_chars, wrapper)) else []
    count = _chars if sum(map(_chars, wrapper)) else lambda node, optional: _size(node)  # of one page no text is known to vary
    while True:
        real = {id(x): (x, o) for x, o in _flat(level, optional)}
        total = sum(count(x, o) for x, o in real.values())
        big = [(x, o) for x, o in real.values() if x[0] != "#" and not x[3] and count(x, o) >= 0.8 * total]
        if not total or len(big) != 1 or _tag(big[0][0][0]) in LEAF or big[0][0][1]:
            break
        path, level, optional = f"{path}/{big[0][0][0]}", big[0][0][6], big[0][1] or big[0][0][2]
    return {"article": sorted(found["article"]), "main": sorted(found["main"]), "dense": path, "constants": constants, "free": sorted(free)}


def _flat(level: list, optional: bool = False):
    """(node, whether an ancestor is optional) of a level, groups passed through."""
    for x in level:
        yield from _flat(x[6], optional or x[2]) if x[0] == "()" else [(x, optional)]


def _ready(known: dict) -> dict:
    """A rule with its paths as sets, and all that these paths begin with."""
    out = {k: set(known[k]) for k in ("article", "main", "free")} | {"dense": {known["dense"]}, "constants": {tuple(x) for x in known["constants"]}}
    out["begins"] = {"/".join(p.split("/")[:k + 1]) for p in {*out["article"], *out["main"], *out["free"], *out["dense"], *(p for p, _ in out["constants"])}
                     for k in range(p.count("/") + 1)}
    return out


def main_text(html: str | None, known: dict) -> str:
    """The main text of a page by its host's rule, else by its own: blocks in page order, one a line."""
    if not html:
        return ""
    return _by(html, known if "begins" in known else _ready(known)) or _by(html, _ready(rule(expression(html), 1)))


def _by(html: str, known: dict) -> str:
    """The main text by a rule. Where all of it is template, the template is the text."""
    blocks: dict[str, list[str]] = {"article": [], "main": [], "dense": []}
    own = {kind: [] for kind in blocks}  # those that aren't template
    there = dict.fromkeys(blocks, False)
    stack: list[tuple] = [(frozenset([""]), False, False, "" in known["dense"], False)]  # paths, in an article, in a main, in the dense element, furniture
    words: list[str] = []

    def flush():
        text = " ".join(unescape("".join(words)).split())
        words.clear()
        paths, *inside, noise = stack[-1]
        if text and not noise:
            same = _same(text)
            template = any((p, same) in known["constants"] for p in paths)
            kept = not _sentence(same) or any(_HEADING.search(p) for p in paths)  # in an article
            for kind, yes in zip(blocks, inside):
                if yes:
                    blocks[kind].append(text)
                    if not template or kind != "dense" and kept:
                        own[kind].append(text)

    for kind, value, noise in read(html):
        if kind == "text":
            if not noise and not stack[-1][4]:
                words.append(value)
            continue
        flush()
        if kind == "open":
            paths, a, m, d, inherited = stack[-1]
            if len(stack) <= DEPTH:
                # a page's element is in the wrapper by its own name, or as one of any class
                paths = frozenset(f"{p}/{x}" for p in paths for x in {value, _wide(value)}) & known["begins"]
                a, m, d = a or not paths.isdisjoint(known["article"]), m or not paths.isdisjoint(known["main"]), d or not paths.isdisjoint(known["dense"])
                noise = inherited or noise and (noise > 1 or paths.isdisjoint(known["free"]))
            else:
                paths, noise = frozenset(), inherited or noise
                a, m = a or _tag(value) == "article" and bool(known["article"]), m or _kind(value) == "main" and bool(known["main"])
            if not noise:
                there["article"] |= a
                there["main"] |= m
            stack.append((paths, a, m, d, bool(noise)))
        elif kind == "close":
            stack.pop()
    flush()
    pick = "article" if there["article"] else "main" if there["main"] else "dense"
    return "\n".join(own[pick] or blocks[pick])


_WRAPPER = "host string, wrapper string, pages long, texts array<string>"
TEXTS = 3  # digests of different pages' texts that are kept of a host; so many tell template from text


def _texts(nodes: list) -> str:
    """A digest of a page's texts."""
    return hashlib.blake2b("\n".join(n[5] or str(n[4]) for _, n, _ in _walk(nodes) if n[0] == "#").encode("utf-8", "replace"), digest_size=12).hexdigest()


def _more(texts: list[str], new) -> list[str]:
    return sorted({*texts, *new})[:TEXTS]


def _both(a: list | None, b: list) -> list:
    """One wrapper of two; pages without a node say nothing about the others."""
    return aligned(a, b) if a and b else a or b


def _induced(batches):
    """Of each host in a task the wrapper of its pages there."""
    held: dict[str, tuple[list, int, list[str]]] = {}

    def rows():
        out = pa.RecordBatch.from_arrays([
            pa.array(list(held), pa.string()), pa.array([json.dumps(w, ensure_ascii=False) for w, _, _ in held.values()], pa.string()),
            pa.array([n for _, n, _ in held.values()], pa.int64()), pa.array([t for _, _, t in held.values()], pa.list_(pa.string()))],
            ["host", "wrapper", "pages", "texts"])
        held.clear()
        return out
    for batch in pieces(batches, "html"):
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one = expression(html or "")
            wrapper, n, texts = held.get(host, (None, 0, []))
            held[host] = (_both(wrapper, one), n + 1, _more(texts, [_texts(one)] if one else []))
        if len(held) > HOSTS:
            yield rows()
    yield rows()


def _met(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper of a host's wrappers, aligned one after the other."""
    wrapper, pages, texts = None, 0, []
    for batch in batches:
        for text, n, some in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("wrapper", "pages", "texts"))):
            wrapper, pages, texts = _both(wrapper, json.loads(text)), pages + n, _more(texts, some)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([json.dumps(wrapper, ensure_ascii=False)], pa.string()),
                                      pa.array([pages], pa.int64()), pa.array([texts], pa.list_(pa.string()))], ["host", "wrapper", "pages", "texts"])


def _ruled(batches):
    for batch in batches:
        found = [(json.loads(w), len(t)) for w, t in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([written(w) for w, _ in found], pa.string()),
            pa.array([json.dumps(rule(w, n), ensure_ascii=False) for w, n in found], pa.string()), batch.column(2)], ["host", "wrapper", "rule", "pages"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://([^/?#\\]*)", 1), F.lit(""))


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, wrapper (as a regular expression), rule (JSON), pages: one row per host, over all its pages.

    A host's pages are aligned within each task first, then the tasks' wrappers in groups, then
    the groups' wrappers: a host with a third of all pages reaches a task as a few rows. Rows
    with a null or odd url are a host of their own, named ''.
    """
    shipped(pages.sparkSession)
    rows = pages.select(host_of(F.col(url).cast("string")).alias("host"), F.col(html).cast("string").alias("html"))
    some = rows.mapInArrow(_induced, _WRAPPER).withColumn("part", F.expr("spark_partition_id() div 64"))
    met = some.groupBy("host", "part").applyInArrow(_met, _WRAPPER).groupBy("host").applyInArrow(_met, _WRAPPER)
    return met.mapInArrow(_ruled, "host string, wrapper string, rule string, pages long")


def _extracted(batches):
    memory: dict[str, dict] = {}
    for batch in pieces(batches, "html"):
        out = []
        for html, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if text not in memory:
                if len(memory) > HOSTS:
                    memory.clear()
                memory[text] = _ready(json.loads(text))
            out.append(main_text(html, memory[text]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row: the main text, blocks joined by one line feed.

    Character references are decoded, white space within a block becomes one space. Null and
    empty pages, and pages without main text, have the text ''. Null ids and urls are rows like
    others, repeated rows are returned each. Odd or broken markup never fails. Whole pages are
    read. An empty table gives no rows; other columns are not read.

    Pages aren't shuffled while the rules of all hosts take RULE_BYTES at most (checked); beyond
    that pages and rules meet by host, a large host split by adaptive skew handling.
    """
    rules = stored(wrappers(pages, url, html).select(F.col("host").alias("_host"), "rule"))
    size = rules.agg(F.sum(F.octet_length("rule") + F.octet_length("_host") + 64)).first()[0] or 0
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"), host_of(F.col(url).cast("string")).alias("_host"))
    met = rows.join(F.broadcast(rules) if size <= RULE_BYTES else rules, "_host")
    return met.select("page_id", "url", "html", "rule").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
