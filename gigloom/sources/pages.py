"""Landed pages as columns.

`nodes` is the only Python step: it turns markup into a flat array of nodes in document
order. A node knows its own position, the last position inside it and its parent, so
"inside", "child of" and "after" are integer comparisons and all selection is done with
Spark array expressions. A page stays one row: choosing elements never shuffles.
"""

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

from gigloom.functions import urls
from gigloom.functions.text import col, let, strip
from gigloom.operators.keys import shuffled
from gigloom.session import bounded_batches, spread
from gigloom.sources.markup import Flat

# executors need no copy of this package: the parser travels with the function
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 100_000

NODE = pa.struct([
    ("pos", pa.int32()), ("last", pa.int32()), ("up", pa.int32()), ("tag", pa.string()), ("cls", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()),
])
NODES = ArrayType(StructType(
    [StructField(n, IntegerType()) for n in ("pos", "last", "up")] + [StructField(n, StringType()) for n in ("tag", "cls")]
    + [StructField("attrs", MapType(StringType(), StringType())), StructField("text", StringType())]))


def _as_structs(pos, last, up, tag, attrs, text) -> pa.StructArray:
    cls, at, keys, values = [], [0], [], []
    for pairs in attrs:
        classes = None
        if len(pairs) == 1:
            key, value = pairs[0]
            keys.append(key)
            values.append(value or "")
            classes = value if key == "class" else None
        elif pairs:
            own = {k: v or "" for k, v in reversed(pairs)}  # the first of repeated attributes counts
            classes = own.get("class")
            keys.extend(own)
            values.extend(own.values())
        cls.append(f" {' '.join(classes.split())} " if classes else None)
        at.append(len(keys))
    held = pa.MapArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
    ints = [pa.array(x, pa.int32()) for x in (pos, last, up)]
    strings = [pa.array(x, pa.string()) for x in (tag, cls)]
    return pa.StructArray.from_arrays([*ints, *strings, held, pa.array(text, pa.string())], fields=list(NODE))


@F.arrow_udf(NODES)
def _nodes(markup: pa.Array) -> pa.Array:
    starts, done = [0], []
    held = [[] for _ in range(6)]
    for page in markup:
        if page.is_valid:
            flat = Flat().read(page.as_py())
            for into, new in zip(held, (range(len(flat.tag)), flat.last, flat.up, flat.tag, flat.attrs, flat.text)):
                into.extend(new)
            starts.append(starts[-1] + len(flat.tag))
        else:
            starts.append(starts[-1])
        if len(held[0]) > CHUNK:  # Python objects are held for a bounded number of nodes only
            done.append(_as_structs(*held))
            held = [[] for _ in range(6)]
    done.append(_as_structs(*held))
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.concat_arrays(done))


def nodes(markup) -> Column:
    return _nodes(F.coalesce(col(markup), F.lit("")))


# --- which nodes --------------------------------------------------------------------

def el(*tags, cls=(), cls_has=None, id=None, **attrs):
    """A test on a node. `data_ui="x"` compares attribute data-ui, `href_has="x"` looks inside it."""
    def test(n):
        ok = n["tag"].isin(*tags) if tags else ~n["tag"].startswith("#")
        for c in [cls] if isinstance(cls, str) else cls:
            ok = ok & F.coalesce(n["cls"].contains(f" {c} "), F.lit(False))
        if cls_has:
            ok = ok & F.coalesce(n["cls"].contains(cls_has), F.lit(False))
        if id:
            ok = ok & F.coalesce(n["attrs"]["id"] == id, F.lit(False))
        for name, wanted in attrs.items():
            inside = name.endswith("_has")
            value = n["attrs"][(name[:-4] if inside else name).replace("_", "-")]
            found = value.isNotNull() if wanted is True else value.contains(wanted) if inside else value == wanted
            ok = ok & F.coalesce(found, F.lit(False))
        return ok
    return test


def either(*tests):
    def test(n):
        ok = tests[0](n)
        for t in tests[1:]:
            ok = ok | t(n)
        return ok
    return test


def child(test):
    """The step matches children only."""
    return ("child", test)


def after(test):
    """The step matches later siblings only."""
    return ("after", test)


def pick(scope, *steps) -> Column:
    """Nodes of a scope reached by the steps (descendants unless marked), in document order.

    The scope's own first node is the starting point and is never picked.
    """
    found = None
    for step in steps:
        axis, test = step if isinstance(step, tuple) else ("inside", step)
        found = _step(scope, found, axis, test)
    return found


def _step(scope, found, axis, test):
    if found is None:
        if axis == "child":
            return let(F.get(scope, F.lit(0))["pos"], lambda top: F.filter(
                scope, lambda n: (n["up"] == top) & test(n)))
        return F.filter(scope, lambda n, i: (i > 0) & test(n))

    def near(n, f):
        if axis == "child":
            return n["up"] == f["pos"]
        if axis == "after":
            return (n["up"] == f["up"]) & (n["pos"] > f["pos"])
        return (n["pos"] > f["pos"]) & (n["pos"] <= f["last"])

    return let(found, lambda fs: F.when(F.size(fs) > 0, F.filter(
        scope, lambda n: test(n) & F.exists(fs, lambda f: near(n, f)))).otherwise(F.slice(scope, 1, 0)))


def first(scope, *steps) -> Column:
    return F.get(pick(scope, *steps), F.lit(0))


def within(scope, node) -> Column:
    """The node and everything inside it, itself a scope."""
    top = F.get(scope, F.lit(0))["pos"]
    return F.slice(scope, node["pos"] - top + 1, node["last"] - node["pos"] + 1)


def each(scope, *steps) -> Column:
    """Array of scopes, one per picked node."""
    return F.transform(pick(scope, *steps), lambda n: within(scope, n))


# --- what they say -------------------------------------------------------------------

def shown(scope) -> Column:
    """Text as displayed: breaks at block edges, other whitespace collapsed."""
    kept = F.filter(scope, lambda n: n["tag"].isin("#text", "#br"))
    runs = F.transform(kept, lambda n: F.when(n["tag"] == "#br", "\n").otherwise(
        F.regexp_replace(n["text"], r"\s+", " ")))
    text = F.regexp_replace(F.array_join(runs, ""), r" ?\n[ \n]*", "\n")
    return strip(let(text, lambda t: F.when(t.contains("  "), F.regexp_replace(t, " {2,}", " ")).otherwise(t)))


def joined(scope, sep="", keep_blank=False) -> Column:
    """Text runs joined by `sep`, each stripped (or kept as they are), blanks dropped."""
    texts = F.transform(F.filter(scope, lambda n: n["tag"] == "#text"), lambda n: n["text"])
    if keep_blank:
        return F.array_join(F.filter(texts, lambda t: strip(t) != ""), sep)
    return F.array_join(F.filter(F.transform(texts, strip), lambda t: t != ""), sep)


def text_at(scope, *steps, sep=None) -> Column:
    """Text of the first picked node; null when nothing is picked."""
    read = shown if sep is None else (lambda s: joined(s, sep))
    return let(first(scope, *steps), lambda n: F.when(n.isNotNull(), read(within(scope, n))))


def attr_at(scope, name, *steps) -> Column:
    return strip(first(scope, *steps)["attrs"][name])


def scope_at(scope, *steps) -> Column:
    return let(first(scope, *steps), lambda n: F.when(n.isNotNull(), within(scope, n)))


def data_at(scope, *steps) -> Column:
    """Contents of the picked script elements."""
    return F.transform(each(scope, *steps), lambda s: F.array_join(F.transform(
        F.filter(s, lambda n: n["tag"] == "#data"), lambda n: n["text"]), ""))


# --- whole-page operators -----------------------------------------------------------

def fetched(pages: DataFrame) -> DataFrame:
    """Pages that answered 200; tables without a status hold only such pages."""
    return pages.where(F.col("status") == 200) if "status" in pages.columns else pages


def captures(pages: DataFrame, wanted: DataFrame, at: str = "url", address=lambda c: F.col(c)) -> DataFrame:
    """Fetched pages whose address (as `address` reads column `at`) is in the one column of `wanted`: the latest of each.

    Later is a later fetched_at, then a larger page_id; kinds of capture and numbered pages of
    one listing count separately. The choice is made without the markup, which is read for
    chosen pages only. Without a page_id all captures count.
    """
    rows = fetched(pages)
    held = shuffled(wanted.toDF("_key").where(F.col("_key").isNotNull()).distinct())
    if "page_id" not in rows.columns:
        return rows.withColumn("_key", address(at)).join(held, "_key", "left_semi").select(*rows.columns)
    variant = [c for c in ("url", "kind", "page_ord") if c in rows.columns and (c != "url" or at != "url")]
    order = [c for c in ("fetched_at", "page_id") if c in rows.columns]
    narrow = rows.select(address(at).alias("_key"), *variant, *order).join(held, "_key", "left_semi")
    chosen = narrow.groupBy("_key", *variant).agg(F.max(F.struct(*order)).alias("_c")).select(
        *[F.col(c).alias(f"_{c}") for c in variant], *[F.col("_c")[c].alias(f"_{c}") for c in order])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*variant, *order] if c != "page_id"]
    return rows.join(shuffled(chosen), [F.col("page_id") == F.col("_page_id"), *same], "left_semi")


def with_nodes(pages: DataFrame, markup: str = "html", to: str = "dom") -> DataFrame:
    """Replace the markup column by its nodes."""
    bounded_batches(pages.sparkSession)
    return spread(pages).withColumn(to, nodes(markup)).drop(markup)


def links(pages: DataFrame) -> DataFrame:
    """One row per anchor with an address: page columns, pos, url as written and resolved, text."""
    keep = [c for c in pages.columns if c != "html"]
    anchors = let(F.col("dom"), lambda d: F.transform(
        pick(d, el("a")), lambda a: F.struct(a["attrs"]["href"].alias("href"), shown(within(d, a)).alias("text"))))
    rows = with_nodes(pages).select(*keep, F.posexplode(F.filter(
        anchors, lambda a: F.coalesce(a["href"], F.lit("")) != "")).alias("pos", "a"))
    return rows.select(*keep, "pos", F.col("a.href").alias("href"),
                       urls.link_from("url", F.col("a.href")).alias("link"), F.col("a.text").alias("text"))


def visible_text(pages: DataFrame) -> DataFrame:
    """Page columns plus `text`, without scripts and styles."""
    keep = [c for c in pages.columns if c != "html"]
    return with_nodes(pages).select(*keep, joined(F.col("dom"), "\n", keep_blank=True).alias("text"))
