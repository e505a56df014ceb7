"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that adds spans.

The field's labels are outside, begin and inside of each kind; its features are shapes of a word and its neighbours
(digits, dots, quotes, signs, lengths), never the word itself. It is trained on a small labelled table of templates
(:func:`labelled_rows`) and decoded by Viterbi. A text is one chain of all its words; it is cut where the weights leave
no label but outside, which changes nothing, and segments of like length are decoded together, so that memory is
bounded by a chunk of texts or the longest segment.

Texts are read whole and only once; nothing is shuffled.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Words, row_runs, tidy, word_chunks

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in ("B", "I")])

# The same matches as the plain patterns, found without trying every start of a long run.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, end and kind (its place in ``KINDS``) of what the patterns find, by start and kind."""
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40:
            digits = _NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out)


# --- features -------------------------------------------------------------------------------------------------------

_CLASSES = ("digit", "letter", "dot", "at", "quote", "dash", "equals", "paren", "slash", "other")
_CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
for _chars, _name in (
    ("0123456789", "digit"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "letter"), (".", "dot"), ("@", "at"), ("\"'`", "quote"), ("-", "dash"), ("=", "equals"), ("()", "paren"), ("/:\\", "slash"),
):
    _CLASS[[ord(c) for c in _chars]] = _CLASSES.index(_name)
_CLASS[128:] = _CLASSES.index("letter")
_COUNTED = tuple(_CLASSES.index(c) for c in ("digit", "letter", "dot", "at", "quote", "dash", "equals", "paren", "slash"))
_PLUS = ord("+")


def shapes(words: Words, some: np.ndarray | None = None) -> np.ndarray:
    """Binary shape features of the words (or of those numbered ``some``), one row each."""
    kind = _CLASS[words.data]
    starts, ends = (words.starts, words.ends) if some is None else (words.starts[some], words.ends[some])
    counts = {}
    for c in _COUNTED:
        total = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind == c, out=total[1:])
        counts[_CLASSES[c]] = total[ends] - total[starts]
    digit, letter, dot = counts["digit"], counts["letter"], counts["dot"]
    size = ends - starts
    first = words.data[starts] if len(starts) else np.zeros(0, np.uint8)
    return np.stack(
        [
            np.ones(len(starts), bool),
            digit > 0,
            (digit > 0) & (letter == 0),
            digit == size,
            counts["at"] == 1,
            (first == _PLUS) & (digit > 0),
            (counts["paren"] > 0) & (digit > 0),
            (dot >= 3) & (digit >= 4) & (letter == 0),
            (digit >= 13) & (letter == 0),
            (digit >= 1) & (digit <= 4) & (letter == 0),
            (counts["dash"] > 0) & (digit > 0),
            counts["quote"] > 0,
            (digit + letter >= 20) & (digit >= 3),
            (counts["equals"] > 0),
            (counts["equals"] > 0) & (size <= 2),
            (letter > 0) & (digit == 0),
            (letter == 0) & (digit == 0),
            counts["slash"] > 0,
            (dot == 1) & (digit > 0) & (letter == 0),
            (digit >= 7) & (digit <= 12) & (letter == 0),
            (letter > 0) & (digit > 0) & (digit + letter < 20),
        ],
        axis=1,
    )


SHAPES = 21


def context(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Shapes of each word, of the one before and of the one after (none across a segment's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first] = False
    ends = np.r_[first[1:] - 1, len(x) - 1] if len(first) else first
    after[ends] = False
    return np.concatenate([x, before, after], axis=1)


# --- the field ------------------------------------------------------------------------------------------------------


def labelled_rows(rows: int = 240, seed: int = 3) -> list[tuple[list[str], list[str]]]:
    """The labelled table: words and labels of short sentences, from templates with random fillers."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    tail = lambda: rng.choice(["", "", "", "", ".", ",", "!!", "###", "***", "%%%", "&&&", "$$$"])
    made = {
        "email": lambda: [f"{word()}.{digits(2)}@{word()}{digits(1)}.{rng.choice(['com', 'org', 'example.com'])}{tail()}"],
        "ip": lambda: [".".join(str(rng.randint(0, 255)) for _ in range(4)) + tail()],
        "card": lambda: rng.choice([[digits(16) + tail()], [digits(4), digits(4), digits(4), digits(4) + tail()], [f"{digits(4)}-{digits(4)}-{digits(4)}-{digits(4)}{tail()}"]]),
        "phone": lambda: rng.choice([[f"+{digits(1)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}{tail()}"], [f"+{digits(2)}", digits(3), digits(4), digits(3) + tail()], [f"+{digits(11)}{tail()}"]]),
        "secret": lambda: [rng.choice(['"{}"', "'{}'"]).format(hexes(rng.choice([32, 40, 64]))) + tail()],
    }
    plain = [
        lambda: ["Version", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}{tail()}"], lambda: ["page", digits(rng.randint(1, 4)) + tail()], lambda: [f"{word()}{digits(1)}"], lambda: ["in", f"{rng.randint(1900, 2030)}{tail()}"],
        lambda: ["|"], lambda: [f"{word()}-{word()}"], lambda: ["=", digits(2)], lambda: ["x", "=", f'"{word()}"'], lambda: [f"http://{word()}.org/{digits(2)}"], lambda: [f"{digits(1)}-{digits(2)}"], lambda: [f"({digits(2)})"],
        lambda: [f"{digits(4)}-{digits(2)}-{digits(2)}"], lambda: [f'"{word()}']
    ]
    table = []
    for i in range(rows):
        words: list[str] = []
        labels: list[str] = []
        for _ in range(rng.randint(1, 3)):
            filler = [word() + tail() for _ in range(rng.randint(1, 4))]
            words += filler
            labels += ["O"] * len(filler)
            if rng.random() < 0.4:
                other = rng.choice(plain)()
                words += other
                labels += ["O"] * len(other)
            else:
                kind = KINDS[(i + rng.randint(0, 4)) % len(KINDS)]
                if kind == "secret" and rng.random() < 0.8:
                    key = [rng.choice(["token", "key", "secret", "password"]), "="]
                    words += key
                    labels += ["O"] * len(key)
                span = made[kind]()
                words += span
                labels += [f"B-{kind}", *[f"I-{kind}"] * (len(span) - 1)]
        words.append(word())
        labels.append("O")
        table.append((words, labels))
    return table


#: Words times segments of one decoding step's back table, unless a single segment is longer.
BACK_CELLS = 1 << 18


class Field:
    """Weights of features by label, of neighbouring labels, and of first labels."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, first: np.ndarray):
        self.emission, self.transition, self.first = emission, transition, first

    def margins(self) -> np.ndarray:
        """By label: the most that a path gains in its transitions by having it rather than outside, whatever its neighbours."""
        t = self.transition
        gain = t.T[:, :, None] + t[:, None, :] - t[:, 0][None, :, None] - t[0][None, None, :]  # label, before, after
        ends = [t - t[0], (t - t[:, :1]).T, self.first[:, None] + t - self.first[0] - t[0], self.first[:, None] - self.first[0]]
        return np.maximum(gain.max(axis=(1, 2)), np.max([e.max(axis=1) for e in ends], axis=0))

    def decode(self, x: np.ndarray, starts: np.ndarray, cut: bool = True) -> np.ndarray:
        """Best labels for chains that begin at ``starts`` in the rows of ``x``: Viterbi over many segments at once.

        A word that outside suits better than any other label by more than transitions can make up for is outside in
        every best path. A chain is cut there, which changes no label: most words of a text are such.
        """
        score = context(x, starts).astype(np.float32) @ self.emission.astype(np.float32)
        n = len(x)
        opens = np.zeros(n, bool)
        opens[starts] = True
        closes = np.r_[opens[1:], True] if n else opens
        sure = (score[:, :1] - score > self.margins() + 1e-3)[:, 1:].all(axis=1) if cut else np.zeros(n, bool)
        out = np.zeros(n, np.int8)
        left, right = ~sure & (opens | np.r_[True, sure[:-1]][:n]), ~sure & (closes | np.r_[sure[1:], True][:n])
        begin, size = np.flatnonzero(left), np.flatnonzero(right) - np.flatnonzero(left) + 1
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        # what comes before a segment is a chain's start or a word outside; so it is after it
        into = np.where(opens[begin][:, None], self.first, self.transition[0]).astype(np.float32)
        onward = np.where(closes[begin + size - 1][:, None], 0, self.transition[:, 0]).astype(np.float32)
        step = self.transition.astype(np.float32)
        lo = 0
        while lo < len(order):  # segments of like length together; longest times number is bounded, so a long one is alone
            hi = lo + max(1, BACK_CELLS // int(size[lo]))
            b, n = begin[lo:hi], size[lo:hi]
            best = score[b] + into[lo:hi]
            back = np.zeros((int(n[0]), len(b), len(LABELS)), np.int8)
            last = best.copy()
            for t in range(1, int(n[0])):
                live = int(np.searchsorted(-n, -t, "left"))  # segments longer than t come first
                reach = best[:live, :, None] + step
                back[t, :live] = reach.argmax(axis=1)
                best = reach.max(axis=1) + score[b[:live] + t]
                last[:live] = best
            label = (last + onward[lo:hi]).argmax(axis=1)
            for t in range(int(n[0]) - 1, -1, -1):
                live = int(np.searchsorted(-n, -t, "left"))
                out[b[:live] + t] = label[:live]
                if t:
                    label[:live] = back[t, np.arange(live), label[:live]]
            lo = hi
        return out


def _packed(table: list[tuple[list[str], list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = [w for row, _ in table for w in row]
    text = pa.array([" ".join(words)])
    (_, _, found), *_ = word_chunks(text, size=1 << 30)
    starts = np.cumsum([0, *[len(row) for row, _ in table]])[:-1]
    return shapes(found), starts, np.array([LABELS.index(y) for _, row in table for y in row])


def train(table: list[tuple[list[str], list[str]]] | None = None, steps: int = 150, penalty: float = 0.02) -> Field:
    """Maximum likelihood with an L2 penalty: forward and backward passes over all rows at once, Adam steps."""
    x, starts, gold = _packed(labelled_rows() if table is None else table)
    features = context(x, starts).astype(np.float64)
    sizes = np.diff(np.r_[starts, len(x)])
    longest, n, k = int(sizes.max()), len(starts), len(LABELS)
    place = starts[:, None] + np.minimum(np.arange(longest), sizes[:, None] - 1)
    live = np.arange(longest) < sizes[:, None]
    y = gold[place]
    parts = [np.zeros((features.shape[1], k)), np.zeros((k, k)), np.zeros(k)]
    seen = [features.T @ np.eye(k)[gold], np.zeros((k, k)), np.eye(k)[gold[starts]].sum(axis=0)]
    both = live[:, 1:]
    np.add.at(seen[1], (y[:, :-1][both], y[:, 1:][both]), 1)
    slow, fast = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emission, transition, first = parts
        score = (features @ emission)[place]
        forward, backward = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        forward[:, 0] = score[:, 0] + first
        for t in range(1, longest):
            new = log_sum(forward[:, t - 1, :, None] + transition, 1) + score[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        whole = log_sum(forward[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            new = log_sum(transition + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live[:, t + 1, None], new, 0.0)
        chance = np.exp(forward + backward - whole[:, None, None])
        expected = [np.zeros_like(parts[0]), np.zeros((k, k)), chance[:, 0].sum(axis=0)]
        flat = np.zeros((len(x), k))
        flat[place[live]] = chance[live]
        expected[0] = features.T @ flat
        for t in range(1, longest):
            pair = forward[:, t - 1, :, None] + transition + (score[:, t] + backward[:, t])[:, None, :] - whole[:, None, None]
            expected[1] += np.exp(pair[live[:, t]]).sum(axis=0)
        for i in range(3):
            gradient = (seen[i] - expected[i]) / n - penalty / 10 * parts[i]
            slow[i] = 0.9 * slow[i] + 0.1 * gradient
            fast[i] = 0.99 * fast[i] + 0.01 * gradient**2
            parts[i] = parts[i] + 0.15 * (slow[i] / (1 - 0.9**step)) / (np.sqrt(fast[i] / (1 - 0.99**step)) + 1e-8)
    return Field(*parts)


_EDGE = "\"'`()[]{}<>,.;:!?*#$%&|"


def added_spans(texts: pa.Array, field: Field) -> dict[int, list[tuple[int, int, int]]]:
    """By row: start, end and kind of what the field marks, in code points, without quotes and punctuation around it."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    for lo, _, words in word_chunks(texts):
        n = len(words.starts)
        if not n:
            continue
        row = words.row_of()
        new = np.r_[True, row[1:] != row[:-1]]  # a text is one chain, all of its words
        labels = field.decode(shapes(words), np.flatnonzero(new))
        begin = np.flatnonzero((labels > 0) & ((labels % 2 == 1) | new | np.r_[True, labels[:-1] == 0]))
        if not len(begin):
            continue
        points = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum((words.data & 0xC0) != 0x80, out=points[1:])
        for b in begin.tolist():
            kind = (int(labels[b]) - 1) // 2
            e = b
            while e + 1 < n and not new[e + 1] and labels[e + 1] == 2 * kind + 2:
                e += 1
            start, end = int(words.starts[b]), int(words.ends[e])
            said = words.data[start:end].tobytes().decode()
            left = len(said) - len(said.lstrip(_EDGE.replace("(", "") if kind == 3 else _EDGE))
            said = said.strip(_EDGE)
            if said:
                i = int(row[b])
                s = int(points[start] - points[words.offsets[i]]) + left
                out.setdefault(lo + i, []).append((s, s + len(said), kind, said))
    return {i: [(s, e, k) for s, e, k, said in spans if _plausible(k, said)] for i, spans in out.items()}


def _plausible(kind: int, said: str) -> bool:
    """The checks of the fixed patterns hold for added spans, too, so that none is a match that they dropped."""
    digits = _NOT_DIGITS.sub("", said)
    if kind == 0:
        return "@" in said[1:-1]
    if kind == 1:
        return len(said.split(".")) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in said.split("."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 if kind == 3 else len(said) >= 16


def all_spans(texts: pa.Array, field: Field) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text: the base spans, and all spans (base and those added that touch none of them), by start and kind."""
    added = added_spans(texts, field)
    for i, text in enumerate(texts.to_pylist()):
        base = base_spans(text) if text else []
        more = [a for a in added.get(i, ()) if all(a[1] <= s or e <= a[0] for s, e, _ in base)]
        yield base, sorted(base + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; spans that overlap become one, of the first's kind."""
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base`` and ``spans`` for each row of ``docs``.

    Counts and ``base`` are those of the fixed patterns; ``spans`` has all. Null and empty texts have none. Rows are
    judged one by one, so repeated rows and null ids are fine; other columns are ignored.
    """
    field = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(lo, hi - lo) for batch in batches for lo, hi in row_runs(batch["text"])):
            rows = [([sum(k == j for _, _, k in base) for j in range(4)], joined(base), joined(spans)) for base, spans in all_spans(part["text"], field.value)]
            counts = [pa.array([r[0][j] for r in rows], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *counts, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans in ``text`` replaced; ``n_chars``, where there is one, follows. A null text stays null."""
    field = docs.sparkSession.sparkContext.broadcast(train())

    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (column.slice(lo, hi - lo) for column in texts for lo, hi in row_runs(column)):
            pairs = zip(part.to_pylist(), all_spans(part, field.value), strict=True)
            yield pa.array([None if t is None else redact(t, spans) if spans else t for t, (_, spans) in pairs], pa.string())

    run = tidy(clean)
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    out = docs.withColumn("text", F.arrow_udf(run, "string")("text"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return out


def op4_pii_spans(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``documents``: counts and digest of the fixed patterns' spans, and all spans; null and empty texts have none."""
    out = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
