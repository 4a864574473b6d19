"""Document fingerprints: a Merkle tree over blocks, paragraphs and sections, in DataFrame operations only.

A paragraph is a line; its leaves are blocks, which end at a sentence's end or
after 32 characters. A leaf's tag is a hash of its text, a paragraph's hash covers
its leaves' tags, a section's those of eight paragraphs, the root all sections.
The fingerprint is the root (128 bits), then the leaves' tags with a mark after
each paragraph and section, so two fingerprints tell whether texts are equal
(roots), which sections and paragraphs differ (branches), and how alike the texts
are (the shared part of their leaves' tags, Dice's coefficient of the sets).

`differences` descends two trees: equal roots end it, then only sections with unequal
hashes are opened, of these only paragraphs with unequal hashes, of these the leaves up
to the first unequal one. Branches are compared by their place, so text that shifts the
later paragraphs makes all of them differ, and a paragraph that one text lacks differs
from leaf 0.

Defined cases: a null text counts as empty; two empty texts are alike (1.0);
repeated rows each come back and follow one another; a null doc_id sorts first;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

#: characters of a leaf, paragraphs of a section
BLOCK, SECTION = 32, 8
_LEAF = r"[^\n.!?]{1,%d}[.!?]*[ \t]*|[.!?]+[ \t]*" % BLOCK


def paragraphs(text: Column) -> Column:
    """For each line of the text the tags (int) of its leaves."""
    leaves = lambda line: F.transform(F.regexp_extract_all(line, F.lit(_LEAF), F.lit(0)), lambda x: F.hash(x))
    return F.transform(F.split(text, "\n", -1), leaves)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once a row: an expression inside a lambda is
    computed for every element, which is quadratic in a text with many paragraphs."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _section(hashes: Column, i: Column) -> Column:
    return F.xxhash64(F.slice(hashes, i * SECTION + 1, SECTION))


def _last_section(n: Column) -> Column:
    return F.floor((n - 1) / SECTION).cast("int")


def paragraph_hashes(paras: Column) -> Column:
    return F.transform(paras, lambda p: F.xxhash64(p))


def sections(paras: Column) -> Column:
    """A hash for each section: of its paragraphs' hashes."""
    return _let(paragraph_hashes(paras), lambda h: F.transform(
        F.sequence(F.lit(0), _last_section(F.size(h))), lambda i: _section(h, i)))


def differences(a_root: Column, a: Column, b_root: Column, b: Column) -> Column:
    """Where two trees differ (roots and `paragraphs`), as an array of (section, paragraph,
    leaf): numbers from 0, the leaf the first unequal one of its paragraph."""
    def first_leaf(x: Column, y: Column) -> Column:
        shorter = F.least(F.size(x), F.size(y))
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)).cast("int") - 1
        return F.when(x.isNull() | y.isNull(), F.lit(0)).when(at < 0, shorter).otherwise(at)

    def descend(t: Column) -> Column:
        n = F.greatest(F.size(t["ha"]), F.size(t["hb"]))
        unequal = F.filter(F.sequence(F.lit(0), _last_section(n)),
                           lambda s: _section(t["ha"], s) != _section(t["hb"], s))
        opened = F.flatten(F.transform(unequal, lambda s: F.filter(
            F.sequence(s * SECTION, F.least(s * SECTION + SECTION, n) - 1),
            lambda i: ~F.get(t["ha"], i).eqNullSafe(F.get(t["hb"], i)))))
        return F.transform(opened, lambda i: F.struct(
            F.floor(i / SECTION).cast("int").alias("section"), i.alias("paragraph"),
            first_leaf(F.get(t["a"], i), F.get(t["b"], i)).alias("leaf")))

    trees = F.struct(a.alias("a"), b.alias("b"), paragraph_hashes(a).alias("ha"), paragraph_hashes(b).alias("hb"))
    nowhere = F.array().cast("array<struct<section:int,paragraph:int,leaf:int>>")
    return F.when(a_root == b_root, nowhere).otherwise(_let(trees, descend))


def root(text: Column, paras: Column) -> Column:
    """128 bits over the section hashes and the text's length; the leaves' own hash is 32 bits, so a
    64-bit hash of the whole text joins them."""
    return F.md5(F.concat_ws(",", F.array_join(F.transform(sections(paras), lambda x: x.cast("string")), ","),
                             F.length(text).cast("string"), F.xxhash64(text).cast("string")))


def fingerprint(text: Column, paras: Column) -> Column:
    """Root, ':', then 8 hex digits per leaf; ',' ends a paragraph and ';' a section."""
    line = lambda p, i: F.concat(
        F.array_join(F.transform(p, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), ""),
        F.when((i + 1) % SECTION == 0, ";").otherwise(","))
    return F.concat(root(text, paras), F.lit(":"), F.array_join(F.transform(paras, line), ""))


def likeness(a_root: Column, a: Column, b_root: Column, b: Column) -> Column:
    """1 for equal roots, else Dice's coefficient of the leaves' tags (distinct arrays)."""
    both = F.size(a) + F.size(b)
    share = F.lit(2.0) * F.size(F.array_intersect(a, b)) / both
    return F.when(a_root == b_root, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(share)


def tags(paras: Column) -> Column:
    return F.array_distinct(F.flatten(paras))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The input with `fingerprint` of its column text added."""
    d = docs.withColumn("_t", text_or_empty()).withColumn("_p", paragraphs(F.col("_t")))
    return d.withColumn("fingerprint", fingerprint(F.col("_t"), F.col("_p"))).drop("_t", "_p")


def _edges(docs: DataFrame, target_bytes: int) -> list[list[int]]:
    """doc_ids that start the buckets (about `target_bytes` of text each), in groups for a two-step search.

    At most 65,536 come to the driver, from an approximate percentile."""
    size, n = docs.agg(F.sum(F.octet_length("text") + 64), F.count("doc_id")).first()
    if not n:
        return []
    k = max(1, min(65_536, (size or 0) // target_bytes))
    q = F.percentile_approx("doc_id", [i / k for i in range(k)], F.lit(max(10_000, 4 * k)))
    low, found = docs.agg(F.min("doc_id"), q).first()
    edges = sorted({low, *found})
    step = max(1, int(len(edges) ** 0.5))
    return [edges[i:i + step] for i in range(0, len(edges), step)]


def with_next(docs: DataFrame, cols: list[str], target_bytes: int = 8 << 20) -> DataFrame:
    """Add next_<c>: the value in the next row by doc_id, after the last row that of the first.

    Rows are dealt into buckets of neighbouring ids, each a window. A bucket's
    first rows (those of its lowest id) also go to the bucket before, so that its
    last row sees them: one shuffle, no global sort. Equal ids follow their text."""
    edges = _edges(docs, target_bytes)
    if not edges:
        return docs.withColumns({f"next_{c}": F.col(c) for c in cols})
    firsts = [x for g in edges for x in g]
    start = [sum(map(len, edges[:i])) for i in range(len(edges))]
    lit = lambda v: F.array(*[F.lit(x) for x in v])
    below = lambda arr, x: F.size(F.filter(arr, lambda e: e <= x))
    # a null id belongs to the first bucket
    d = docs.withColumn("_group", F.greatest(F.coalesce(below(lit([g[0] for g in edges]), F.col("doc_id")), F.lit(1)),
                                             F.lit(1)))
    member = F.element_at(F.array(*[lit(g) for g in edges]), F.col("_group"))
    within = F.greatest(F.coalesce(below(member, F.col("doc_id")), F.lit(1)), F.lit(1))
    d = d.withColumn("_bucket", F.element_at(lit(start), F.col("_group")) + within - 1)
    is_first = F.col("doc_id").isNull() | (F.col("doc_id") == F.element_at(lit(firsts), F.col("_bucket") + 1))
    nulls = docs.filter(F.col("doc_id").isNull()).limit(1).count()
    wraps = F.col("doc_id").isNull() if nulls else F.col("doc_id") == firsts[0]
    own = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("borrowed"))
    back = F.struct((F.col("_bucket") - 1).alias("b"), F.lit(1).alias("borrowed"))
    last = F.struct(F.lit(len(firsts) - 1).alias("b"), F.lit(2).alias("borrowed"))
    to = F.filter(F.array(own, F.when(is_first & (F.col("_bucket") > 0), back), F.when(wraps, last)),
                  lambda x: x.isNotNull())
    d = d.withColumn("_to", F.explode(to))
    order = W.partitionBy("_to.b").orderBy(F.col("_to.borrowed"), F.col("doc_id"), F.xxhash64("text"))
    d = d.withColumns({f"next_{c}": F.lead(c).over(order) for c in cols})
    return d.filter("_to.borrowed = 0").drop("_group", "_bucket", "_to")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form (its last quarter replaced by
    the start of the next document), how alike they and the next text's are, and the
    places (`edited_at`) where the edited text's tree differs."""
    d = docs.select("doc_id", text_or_empty().alias("text"))
    d = d.withColumn("paras", paragraphs(F.col("text")))
    d = d.select("doc_id", "text", "paras", root(F.col("text"), F.col("paras")).alias("root"))
    d = with_next(d, ["text", "paras", "root"])
    n = F.length("text").cast("long")
    k = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - k), F.substring("next_text", F.lit(1), k))
    d = d.withColumns({"n_chars": n, "edited": edited}).withColumn("edited_paras", paragraphs(F.col("edited")))
    d = d.withColumns({"tags": tags(F.col("paras")), "edited_root": root(F.col("edited"), F.col("edited_paras"))})
    near = lambda r, p: likeness(F.col("root"), F.col("tags"), F.col(r), tags(F.col(p)))
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("paras")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_paras")).alias("edited_fingerprint"),
        near("edited_root", "edited_paras").alias("near_edited"), near("next_root", "next_paras").alias("near_next"),
        differences(F.col("root"), F.col("paras"), F.col("edited_root"), F.col("edited_paras")).alias("edited_at"))
