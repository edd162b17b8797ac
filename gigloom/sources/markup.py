"""Markup to flat lists of nodes, in one pass.

A scanner goes through the markup once and never back: each step ends a text, a tag, an attribute or a comment and goes on
from there, or finds that one has no end, and then the markup ends in it, as in a browser. So any input, hostile ones
included, is read in time proportional to its length.
"""

import re
import sys
from html import unescape

from pyspark import cloudpickle

# executors need no copy of this package: the scanner travels with the function that uses it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main nav ol option p pre section table tbody td th thead tr ul".split())
# an opening tag ends an open element of these kinds, unless the stopper lies between
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "a": ({"a"}, BREAKS - {"br", "hr"}),
}
HIDDEN = frozenset(["script", "style", "template"])

# a `<` that begins something; any other is text
_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\t\n\r\f />]*+)|!--|[!?]|/)")
# an attribute of a start tag: its name, and perhaps a quoted or bare value; with a quote that is never closed it is none
_ATTR = (r"[\t\n\r\f /]*+[^\t\n\r\f />][^\t\n\r\f />=]*+"
         r"(?:[\t\n\r\f ]*+=[\t\n\r\f ]*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\t\n\r\f >]*+)|(?![\t\n\r\f ]*+=))")
_PARTS = re.compile(
    r"[\t\n\r\f /]*+([^\t\n\r\f />][^\t\n\r\f />=]*+)"
    r"(?:[\t\n\r\f ]*+(=)[\t\n\r\f ]*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\t\n\r\f >]*+)))?")
# text without a `<`, then a whole end tag, or a whole start tag with all its attributes
_STEP = re.compile(
    r"([^<]*+)<(?:/([a-zA-Z][^\t\n\r\f />]*+)[^>]*+>"
    rf"|([a-zA-Z][^\t\n\r\f />]*+)((?:{_ATTR})*+)[\t\n\r\f /]*+>)")
_COMMENT_END = re.compile(r"--!?[\t\n\r\f ]*+>")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\t\n\r\f />])", re.I) for tag in ("script", "style")}
# ends its element from within a table inside it too
_THROUGH = frozenset(["table", "ul", "ol", "div", "body", "html"])
_NEITHER = (None, False, False)
# of a start tag: what it ends, whether it begins on a new line, whether it stands alone
_KINDS = {t: (IMPLIED_END.get(t), t in BREAKS, t in VOID) for t in {*IMPLIED_END, *BREAKS, *VOID}}


class Flat:
    """One entry for each element and text run, in document order; the first is the page.

    The open elements of each kind are kept on a stack of their own, so the nearest one is found without walking over the
    others. `last` is the last entry inside an element, `up` the element around.
    """

    def __init__(self):
        self.up, self.last, self.tag, self.attrs, self.text = [-1], [0], ["#root"], [()], [None]
        self.open = [0]
        self.at = {}  # depths of the open elements of each kind

    def add(self, tag, text=None):
        self.up.append(self.open[-1])
        self.last.append(len(self.tag))
        self.tag.append(tag)
        self.attrs.append(())
        self.text.append(text)

    def shut(self, depth):
        if depth is None:
            return
        end = len(self.tag) - 1
        for at in reversed(self.open[depth:]):
            self.last[at] = end
            if at:
                self.at[self.tag[at]].pop()
        del self.open[depth:]

    def nearest(self, names, stoppers=()):
        depth = max((self.at[n][-1] for n in names if self.at.get(n)), default=None)
        if depth is None or any(self.at[n][-1] > depth for n in stoppers if self.at.get(n)):
            return None
        return depth

    def started(self, tag, attrs):
        ends, breaks, alone = _KINDS.get(tag, _NEITHER)
        at, tags, opened = self.at, self.tag, self.open
        if ends:
            self.shut(self.nearest(*ends))
        if breaks:
            if tag != "br" and at.get("p"):
                self.shut(self.nearest({"p"}, {"button", "td", "th", "table"}))
            if tags[-1] != "#br":
                self.add("#br")
        here = len(tags)
        self.up.append(opened[-1])
        self.last.append(here)
        tags.append(tag)
        self.attrs.append(attrs)
        self.text.append(None)
        if not alone:
            if tag in at:
                at[tag].append(len(opened))
            else:
                at[tag] = [len(opened)]
            opened.append(here)

    def ended(self, tag):
        depths = self.at.get(tag)
        if not depths:
            return
        if depths[-1] == len(self.open) - 1:  # the innermost element
            depths.pop()
            self.last[self.open.pop()] = len(self.tag) - 1
        elif tag not in _THROUGH and self.at.get("table") and self.at["table"][-1] > depths[-1]:
            return
        else:
            self.shut(depths[-1])
        if tag in BREAKS and self.tag[-1] != "#br":
            self.add("#br")

    def said(self, text):
        hidden = self.tag[self.open[-1]] in HIDDEN
        self.add("#data" if hidden else "#text", unescape(text) if "&" in text else text)

    def read(self, markup):
        at, end, step = 0, len(markup), _STEP.match
        while at < end:
            found = step(markup, at)
            if found is None:
                at = self.past(markup, at)
                continue
            text, closed, tag, written = found.groups()
            if text:
                self.said(text)
            at = found.end()
            if closed:
                self.ended(closed.lower())
                continue
            attrs = ()
            if written:
                attrs = []
                for name, given, double, single, bare in _PARTS.findall(written):
                    value = double or single or bare
                    attrs.append((name.lower(), (unescape(value) if "&" in value else value) if given else None))
            tag = tag.lower()
            self.started(tag, attrs)
            if tag in _RAW_END and markup[at - 2] != "/":
                close = _RAW_END[tag].search(markup, at)
                stop = close.start() if close else end
                if stop > at:
                    self.add("#data", markup[at:stop])
                at = stop
        self.shut(0)
        return self

    def past(self, markup, at):
        """Take in what no step does: text with a `<`, a comment, a declaration, a tag without an end; where the scan goes on."""
        end, mark = len(markup), _MARK.search(markup, at)
        start = mark.start() if mark else end
        if start > at:
            self.said(markup[at:start])
        if mark is None or mark[2] and start == at:  # a tag that a step hasn't taken has no end
            return end
        at = mark.end()
        if mark[2]:
            return start
        if mark[0] == "<!--":
            if markup.startswith(">", at) or markup.startswith("->", at):
                return markup.index(">", at) + 1
            close = _COMMENT_END.search(markup, at)
            return close.end() if close else end
        close = markup.find(">", at)
        return close + 1 if close >= 0 else end
