"""Personal data by candidate gradient boosting.

1. High-recall generators propose overlapping spans: everything that looks like an
   address at a host (also with the signs spelled out), and of every run of digits and
   separators each stretch of consecutive pieces (between blanks, commas and slashes)
   whose digits fit a kind, once for each kind it might be.
2. Strict patterns with their checks (the base) find spans that always count.
3. Boosted trees score the other candidates by format (digits, groups, separators,
   checksums, ranges) and context (neighbouring characters and words). They learn
   from all candidates of all documents: base spans and rewritings of them that the base
   does not cover are positive, other candidates negative. Equal examples are counted
   where they are found, and the counted ones binned and counted again. A threshold per
   kind is calibrated for the wanted precision on all candidates, each judged by trees that
   did not see it; a kind that reaches it nowhere, or has under `least_positives`
   positives, adds nothing.
4. Finding is a map over whole texts. Added spans overlap no base span and no better
   candidate.

Scans are linear in the text, spans are looked up by bisection. Offsets are code points.

Defined cases: a null text counts as empty; repeated rows each come back; without
training candidates only the base is found; other columns are kept by `redact` and
ignored by `find`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import boosting
from strata.llm.common import Scratch, map_columns, ship

KINDS = ("email", "ip", "card", "phone")
#: wanted precision, least probability, steps of the probabilities that may be thresholds
PRECISION, LEAST, STEPS = 0.99, 0.9, 1 << 16
#: positive examples that a kind needs to add spans, and parts of the examples that are judged in turn
LEAST_POSITIVES, FOLDS = 10, 3
#: examples as which all of a kind and label weigh at most, so that a rare kind isn't outweighed
WEIGHT = 2_500
#: distinct binned examples that the driver learns from by itself; more are learnt from by tasks, with the same result
ALONE = 200_000

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<![\w.])([A-Za-z0-9._%+-]{1,64}) ?(?:@|[(\[]at[)\]]| at ) ?"
                      r"([A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]| dot ) ?[A-Za-z0-9-]{1,63})*)(?![\w-])")
_SPELLED_HINT = re.compile(r"[(\[](?:at|dot)[)\]]| at \S+ dot |@")
_RUN = re.compile(r"[+(]?[0-9](?:[0-9]|[ ().,/:_-]{1,3}(?=[0-9(]))*")
_DIGIT = re.compile(r"[0-9]")
_GAP = re.compile(r"[ ,/]+")
_GROUP = re.compile(r"[0-9]+")
_WORD_BEFORE = re.compile(r"(\w+)\W{0,3}$")
_HINTS = {"email": ("email", "mail", "e", "contact"), "ip": ("ip", "host", "server", "address"),
          "card": ("card", "visa", "mastercard", "credit", "account"),
          "phone": ("phone", "tel", "call", "mobile", "fax", "contact")}
_OTHER_HINTS = ("version", "v", "no", "id", "page", "chapter", "year", "license", "cc", "isbn", "password", "key")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    return len(digits.lstrip("0")) <= 3 and int(digits.lstrip("0") or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from each @ to both sides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the strict patterns whose checks hold, in order."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(map(_octet, m.group().split(".")))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text)
                if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def _pieces(run: str, at: int) -> list[tuple[int, int, int, int]]:
    """(start, end, digits, groups of digits) of a run's parts between wider separators."""
    out, cut = [], 0
    for gap in [*_GAP.finditer(run), None]:
        end = gap.start() if gap else len(run)
        part = run[cut:end]
        out.append((at + cut, at + end, len(_digits(part)), len(_GROUP.findall(part))))
        cut = gap.end() if gap else end
    return out


def candidates(text: str) -> list[tuple[int, str, int]]:
    """Proposed spans of all kinds; they may overlap."""
    out = []
    if _SPELLED_HINT.search(text):
        out += [(m.start(), "email", m.end()) for m in _SPELLED.finditer(text)]
    if not _DIGIT.search(text):
        return out
    for m in _RUN.finditer(text):
        pieces = _pieces(m.group(), m.start())
        after = [len(pieces)] * len(pieces)  # the next piece with digits
        for j in range(len(pieces) - 2, -1, -1):
            after[j] = j + 1 if pieces[j + 1][2] else after[j + 1]
        for i, (s, _, digits, _) in enumerate(pieces):
            d = groups = 0
            j = i
            while j < len(pieces):  # 40 characters, then 19 pieces with digits at most, so linear in the run
                e, d, groups = pieces[j][1], d + pieces[j][2], groups + pieces[j][3]
                far = e - s > 40  # from here on it starts and ends with digits
                if d > 19 or far and not digits:
                    break
                j, whole = after[j] if far else j + 1, not far or pieces[j][2] > 0
                if not whole:
                    continue
                if 7 <= d <= 15:
                    out.append((s, "phone", e))
                if 12 <= d <= 19:
                    out.append((s, "card", e))
                if groups == 4 and 4 <= d <= 12:
                    out.append((s, "ip", e))
    return out


def features(text: str, span: tuple[int, str, int]) -> list[float]:
    a, kind, b = span
    s = text[a:b]
    d = _digits(s)
    parts = _GROUP.findall(s)
    groups = [len(g) for g in parts] or [0]
    before = _WORD_BEFORE.search(text[max(0, a - 24):a])
    word = before.group(1).lower() if before else ""
    left, right = text[a - 1:a], text[b:b + 1]
    tail = re.split(r"\.| dot |[(\[]dot[)\]]", s)[-1].strip()
    return [KINDS.index(kind), len(s), len(d), len(groups), max(groups), min(groups), groups[0], groups[-1],
            s.count(" "), s.count("-"), s.count("."), s.count("(") + s.count(")"), s.count("/") + s.count(":") + s.count(","),
            s.startswith("+"), s.startswith("("), s.count("@"), " at " in s or "at)" in s or "at]" in s,
            len(re.findall(r"\.| dot |[(\[]dot[)\]]", s)), len(tail) if tail.isalpha() else 0,
            bool(d) and 12 <= len(d) <= 19 and luhn(d), bool(d) and d[0] in "3456",
            len(parts) == 4 and all(map(_octet, parts)), bool(parts) and parts[0].strip("0") != "", len(set(d)),
            left.isalnum() or left in ("=", "_"), right.isalnum() or right == "_", left.isspace() or not left,
            right.isspace() or not right, word in _HINTS[kind], word in _OTHER_HINTS, word.isdigit()]


def rewritten(text: str, span: tuple[int, str, int], seed: int) -> tuple[str, tuple[int, str, int]]:
    """The text with a base span in another customary form, and the span there."""
    a, kind, b = span
    s, rng = text[a:b], np.random.default_rng([5, seed, a])
    pick = lambda *x: x[int(rng.integers(len(x)))]
    if kind == "email":
        at, dot = pick((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", "."), (" @ ", "."))
        local, domain = s.split("@", 1)
        new = local + at + domain.replace(".", dot)
    elif kind == "ip":
        new = s.replace(".", pick(" . ", "-", ". ", "_"))
    elif kind == "card":
        d = _digits(s)
        new = pick(".", "/", "  ", "_").join(d[i:i + 4] for i in range(0, len(d), 4))
    else:
        d = _digits(s)
        local = d[-10:] if len(d) > 10 else d
        new = pick(f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}",
                   f"00{d[:-10]} {local[:3]} {local[3:6]} {local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}")
    return text[:a] + new + text[b:], (a, kind, a + len(new))


class _Taken:
    """Stretches of a text in order, overlapping ones joined; each look-up is a bisection."""

    def __init__(self, spans: list[tuple[int, str, int]] = ()):
        self.starts, self.ends = [], []
        for s, _, e in sorted(spans, key=lambda c: c[0]):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def overlaps(self, span: tuple[int, str, int]) -> bool:
        at = bisect_left(self.starts, span[2]) - 1  # the last that starts before the span's end
        return at >= 0 and self.ends[at] > span[0]

    def add(self, span: tuple[int, str, int]) -> None:
        """Add a span that overlaps none."""
        at = bisect_left(self.starts, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


@dataclass
class Model:
    trees: boosting.Boosted = field(default_factory=boosting.Boosted)
    thresholds: dict = field(default_factory=dict)

    def added(self, text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
        if not self.thresholds:
            return []
        taken = _Taken(base)
        proposed = [c for c in candidates(text) if c[1] in self.thresholds and not taken.overlaps(c)]
        if not proposed:
            return []
        p = np.concatenate([  # some at a time, as a long table of numbers has many
            self.trees.probability(np.array([features(text, c) for c in proposed[i:i + 10_000]], np.float64))
            for i in range(0, len(proposed), 10_000)])
        out: list[tuple[int, str, int]] = []
        for i in np.lexsort((range(len(p)), -p)):
            c = proposed[i]
            if p[i] >= self.thresholds[c[1]] and not taken.overlaps(c):
                out.append(c)
                taken.add(c)
        return out

    def spans(self, text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
        """The base, and base and added spans, by start and kind."""
        base = base_spans(text)
        order = lambda c: (c[0], KINDS.index(c[1]))
        return base, sorted(base + self.added(text, base), key=order)


def examples(text: str, seed: int) -> Iterator[tuple[int, list[float]]]:
    """(label, features) of a text's candidates and of the rewritings of its base spans."""
    base = base_spans(text)
    yield from ((1, features(text, c)) for c in base)
    taken = _Taken(base)
    yield from ((0, features(text, c)) for c in candidates(text) if not taken.overlaps(c))
    for c in base:
        changed, span = rewritten(text[max(0, c[0] - 60):c[2] + 60],
                                  (c[0] - max(0, c[0] - 60), c[1], c[2] - max(0, c[0] - 60)), seed)
        proposed = candidates(changed)
        if span in proposed:
            yield 1, features(changed, span)
            strict, own = _Taken(base_spans(changed)), _Taken([span])
            yield from ((0, features(changed, p)) for p in proposed  # a part of it, or another kind
                        if p != span and not strict.overlaps(p) and own.overlaps(p))


def counted(texts: list[str | None], seeds: list[int | None], most: int = 50_000) -> Iterator[Counter]:
    """How often each (label, features as bytes) occurs, told whenever `most` distinct ones are held."""
    got, held = Counter(), []

    def count() -> None:
        rows = np.array([x for _, x in held], np.float64)
        got.update((y, r.tobytes()) for (y, _), r in zip(held, rows))
        held.clear()

    for text, seed in zip(texts, seeds):
        for one in examples(text or "", (seed or 0) % (1 << 31)):
            held.append(one)
            if len(held) == 10_000:
                count()
                if len(got) > most:
                    yield got
                    got = Counter()
    count()
    yield got


def _matrix(table: pa.Table | pa.RecordBatch, column: str, dtype: type) -> np.ndarray:
    rows = table.column(column).to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


#: columns of the examples dealt to each fold
_SHARES = [f"n{f}" for f in range(FOLDS)]


def _counts(table: pa.Table) -> np.ndarray:
    """Examples that each model learns from: all outside its fold; the last one from all."""
    n = table["n"].to_numpy()
    return np.stack([n - table[c].to_numpy() for c in _SHARES] + [n])


def _found(docs: DataFrame) -> DataFrame:
    """Distinct examples (kind, y, features x) of all documents, how often each occurs (n) and, dealt in
    turn, in each fold (n0, n1, ...)."""
    def run(cols: dict) -> Iterator[dict]:
        for got in counted(cols["text"], cols["doc_id"]):
            yield {"kind": [int(np.frombuffer(x[:8])[0]) for _, x in got], "y": [y for y, _ in got],
                   "x": [x for _, x in got], "n": list(got.values())}

    found = (map_columns(docs.select("doc_id", "text"), run, "kind int, y int, x binary, n long")
             .groupBy("kind", "y", "x").agg(F.sum("n").alias("n")))
    turn = lambda f: F.pmod(F.lit(f) - F.xxhash64("x") % FOLDS, F.lit(FOLDS))
    return found.withColumns({c: F.floor((F.col("n") + (FOLDS - 1) - turn(f)) / FOLDS).cast("long")
                              for f, c in enumerate(_SHARES)})


def _cuts(found: DataFrame, weight: np.ndarray) -> list[np.ndarray]:
    """Values of each feature at equal steps of the examples' weights by kind and label."""
    bins = boosting.BINS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "x", np.float64)
            own = batch.column("n").to_numpy() * weight[batch.column("kind").to_numpy(), batch.column("y").to_numpy()]
            own = np.maximum(1, np.rint(own * 1e9)).astype(np.int64)
            for f in range(x.shape[1]):
                v, at = np.unique(x[:, f], return_inverse=True)
                w = np.zeros(len(v), np.int64)
                np.add.at(w, at, own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v), pa.array(w)],
                                                 ["f", "v", "w"])

    of = Window.partitionBy("f")
    ends = found.select("kind", "y", "x", "n").mapInArrow(run, "f int, v double, w long").groupBy("f", "v").agg(
        F.sum("w").alias("w")).withColumns({"end": F.sum("w").over(of.orderBy("v")), "all": F.sum("w").over(of)})
    step = F.expr(f"({bins} * (end - w) + all - 2) div (all - 1)")  # the first that isn't before this value
    rows = ends.withColumn("k", step).where(f"k < {bins} AND k * (all - 1) div {bins} < end").select("f", "v").collect()
    return [np.sort([r["v"] for r in rows if r["f"] == f]) for f in range(1 + max(r["f"] for r in rows))]


def fit(docs: DataFrame, precision: float = PRECISION, least_positives: int = LEAST_POSITIVES, weight: int = WEIGHT,
        alone: int = ALONE) -> Model:
    """Fit on all candidates of all documents. All examples of a kind and label weigh as `weight` of them at
    most. Up to `alone` distinct binned examples are learnt from in the driver, more by tasks."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(_found(docs), "pii-found")
    total = np.zeros((FOLDS + 1, len(KINDS), 2))
    for r in found.groupBy("kind", "y").agg(*[F.sum(c).alias(c) for c in ("n", *_SHARES)]).collect():
        total[:, r["kind"], r["y"]] = [r["n"] - r[c] for c in _SHARES] + [r["n"]]
    if not total[-1].sum(axis=0).all():
        scratch.drop(found)
        return Model()
    # the kinds count alike up to their examples, then the labels do
    bound = np.minimum(1, weight / np.maximum(1, total))
    label = (total * bound).sum(axis=1)
    factor = bound * (0.5 / np.maximum(1, label) * label.sum(axis=1, keepdims=True))[:, None, :]
    share = (total * factor).sum(axis=1)
    base = boosting.log_odds(share[:, 1] / share.sum(axis=1))
    cuts = _cuts(found, bound[-1])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = [r.tobytes() for r in boosting.binned(_matrix(batch, "x", np.float64), cuts)]
                yield batch.drop_columns(["x"]).append_column("code", pa.array(codes, pa.binary()))

    sums = ", ".join(f"{c} long" for c in ("n", *_SHARES))
    coded = scratch.write(found.mapInArrow(code, f"kind int, y int, {sums}, code binary").groupBy("kind", "y", "code").agg(
        *[F.sum(c).alias(c) for c in ("n", *_SHARES)]), "pii-coded")

    def read(table: pa.Table) -> boosting.Examples:
        y = table["y"].to_numpy()
        return boosting.Examples(_matrix(table, "code", np.uint8), y,
                                 _counts(table) * factor[:, table["kind"].to_numpy(), y], base)

    def judged(table: pa.Table, had: boosting.Examples, rounds: list) -> pa.RecordBatch:
        """Candidates and positives by kind and step of the probability that the trees of another fold give."""
        had.follow(rounds)
        step = np.floor(STEPS / (1 + np.exp(-had.margin[:FOLDS]))).astype(np.int64).ravel()
        kind, n = np.tile(table["kind"].to_numpy(), FOLDS), np.concatenate([table[c].to_numpy() for c in _SHARES])
        use = (step >= LEAST * STEPS) & (n > 0)
        place, at = np.unique(kind[use] * (STEPS + 1) + step[use], return_inverse=True)
        out = np.zeros((2, len(place)), np.int64)
        np.add.at(out[0], at, n[use])
        np.add.at(out[1], at, (n * np.tile(had.y, FOLDS))[use])
        return pa.RecordBatch.from_arrays([pa.array(place), pa.array(out[0]), pa.array(out[1])], ["place", "n", "good"])

    if coded.count() <= alone:
        table = coded.toArrow()
        had = read(table)
        models, rounds = boosting.grow(had.sums, cuts, base)
        steps = judged(table, had, rounds).to_pylist()
    else:
        models, rounds = boosting.grow(boosting.spread(coded, read), cuts, base)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                table = pa.Table.from_batches(held)
                yield judged(table, read(table), rounds)

        steps = coded.mapInArrow(judge, "place long, n long, good long").groupBy("place").agg(
            F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
    scratch.drop(found, coded)
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = sorted(((r["place"] % (STEPS + 1), r["n"], r["good"]) for r in steps if r["place"] // (STEPS + 1) == k), reverse=True)
        if own and total[-1, k, 1] >= least_positives:
            step, n, good = (np.array(c) for c in zip(*own))
            right = np.flatnonzero(np.cumsum(good) >= precision * np.cumsum(n))
            if len(right):
                thresholds[kind] = float(step[right[-1]] / STEPS)
    return Model(models[-1], thresholds)


def _told(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 and all spans of every whole text."""
    ship(docs.sparkSession)
    model_b = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def run(cols: dict) -> dict:
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in cols["text"]:
            base, spans = model_b.value.spans(text or "")
            for k in KINDS:
                out[f"n_{k}"].append(sum(c[1] == k for c in base))
            out["base_sha256"].append(hashlib.sha256(_told(base).encode()).hexdigest())
            out["spans"].append(_told(spans))
        return {"doc_id": cols["doc_id"]} | out

    return map_columns(docs.select("doc_id", "text"), run, "doc_id long, n_email long, n_ip long, n_card long, "
                       "n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """Every span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for a, kind, b in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with their spans redacted; n_chars follows the text where it changed."""
    ship(docs.sparkSession)
    model_b = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t, model_b.value.spans(t)[1]) for t in texts], dtype=object)

    out = docs.withColumn("_new", F.pandas_udf(run, "string")("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_new") != F.col("text"), F.length("_new").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("_new")).select(*docs.columns)
