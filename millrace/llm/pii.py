"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ["email", "ip", "card", "phone"]
LONGEST = 24  # tokens of a segment that the model scores: the bound of the dynamic programme
SAMPLE_DOCS = 2000  # documents with a base span that the model is fitted on
CONTEXT = 60  # characters around a trigger that enter a window
EPOCHS = 6

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each pattern, those failing its condition dropped."""
    out = []
    last = 0
    for m in _AT.finditer(text) if "@" in text else ():
        # a match starts where its run of local characters starts, or where the last match ended
        start = m.start()
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            last = m.end()
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _valid_ip(m.group())]
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


# --- the model -----------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|\d+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9@]|\[at\]|\(at\)", re.I)


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


@lru_cache(maxsize=200_000)
def shape(text: str) -> str:
    """Letters to ``a``, digits to ``9``, white space to a blank, runs of one class shortened to three."""
    s = re.sub(r"\s+", " ", re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "a", text)))
    return re.sub(r"(a)\1{3,}|(9)\2{4,}", lambda m: m.group()[0] * (3 if m.group()[0] == "a" else 5), s)


@lru_cache(maxsize=200_000)
def span_features(text: str) -> tuple[str, ...]:
    """Features of a whole candidate span; they see all of it, not its tokens one by one."""
    d = _digits(text)
    groups = [len(g) for g in re.findall(r"\d+", text)]
    letters = sum(c.isalpha() for c in text)
    at = text.count("@") + len(re.findall(r"[\[(]at[\])]", text, re.I))
    inner = set(re.sub(r"[\w]", "", text))
    marks = "".join(sorted(inner & set(" .-()+@/[]")))
    found = [
        f"digits={min(len(d), 20)}", f"groups={min(len(groups), 6)}", f"marks={marks}", f"at={min(at, 2)}",
        f"letters={min(letters, 4)}", f"odd={bool(inner - set(' .-()+@_%/[]'))}",
    ]
    if 12 <= len(d) <= 19 and not letters:
        found.append(f"luhn={luhn(d)}")
    if len(groups) == 4 and not letters:
        found.append(f"octets={all(g <= 3 for g in groups) and _valid_ip('.'.join(re.findall(r'[0-9]+', text)) or '999')}")
    if at == 1:
        name, host = re.split(r"@|\s?[\[(]at[\])]\s?", text, maxsplit=1, flags=re.I)
        found += [f"host_dots={min(host.count('.'), 3)}", f"name={bool(re.fullmatch(r'[\w.%+-]+', name))}", f"host={bool(re.fullmatch(r'[\w-]+([.][\w-]+)+', host))}"]
    if text[:1] in "+(":
        found.append(f"opens={text[0]}")
    return tuple(found)


def _edge(text: str, at: int, step: int) -> str:
    c = text[at:at + 1] if 0 <= at < len(text) else ""
    return "end" if not c else "blank" if c.isspace() else "letter" if c.isalpha() else "digit" if c.isdigit() else c


def _possible(text: str) -> bool:
    """Segments that can hold personal data at all: they have a digit or an at sign and sound edges."""
    return not (text[0].isspace() or text[-1].isspace() or "\n" in text) and (_TRIGGER.search(text) is not None)


class SpanModel:
    """Log-linear weights of (kind, feature); segments outside any span score 0 per token."""

    def __init__(self):
        self.weights: dict[tuple[str, str], float] = {}

    def features(self, text: str, start: int, end: int) -> list[str]:
        return [*span_features(text[start:end]), "before=" + _edge(text, start - 1, -1), "after=" + _edge(text, end, 1), "bias"]

    def score(self, kind: str, features: list[str]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in features)

    def segments(self, text: str, begin: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, list[str]]]]:
        """Tokens of a window, and the candidate segments as (first token, last token, features)."""
        cut = [(a + begin, b + begin) for a, b in tokens(text[begin:end])]
        out = []
        for i, (a, _) in enumerate(cut):
            if text[a].isspace() or text[a] in ".,;:!?)]":
                continue
            for j in range(i, min(i + LONGEST, len(cut))):
                b = cut[j][1]
                piece = text[cut[j][0]:b]
                if "\n" in piece:
                    break
                if piece.isspace() or not piece[-1].isalnum():
                    continue
                if sum(1 for x in range(i, j + 1) if text[cut[x][0]].isspace()) > 4:
                    break
                if _possible(text[a:b]):
                    out.append((i, j, self.features(text, a, b)))
        return cut, out

    def best(self, text: str, begin: int, end: int) -> list[tuple[str, int, int]]:
        """The best segmentation of a window: boundaries and kinds chosen together."""
        cut, found = self.segments(text, begin, end)
        ending: dict[int, list[tuple[int, str, float]]] = {}
        for i, j, features in found:
            for kind in KINDS:
                s = self.score(kind, features)
                if s > 0:
                    ending.setdefault(j, []).append((i, kind, s))
        score, back = [0.0] * (len(cut) + 1), [None] * (len(cut) + 1)
        for j in range(len(cut)):
            score[j + 1] = score[j]
            for i, kind, s in ending.get(j, ()):
                if score[i] + s > score[j + 1]:
                    score[j + 1], back[j + 1] = score[i] + s, (i, kind)
        spans, at = [], len(cut)
        while at:
            if back[at]:
                i, kind = back[at]
                spans.append((kind, cut[i][0], cut[at - 1][1]))
                at = i
            else:
                at -= 1
        return spans[::-1]

    def fit(self, examples: list[tuple[str, set[tuple[str, int, int]]]], epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-4) -> None:
        """Gradient steps on the conditional likelihood: expected against given segment features.

        Expectations come from the forward and backward sums of the segmentation lattice.
        """
        prepared = []
        for text, gold in examples:
            cut, found = self.segments(text, 0, len(text))
            prepared.append((cut, found, {(a, b): k for k, a, b in gold}))
        for epoch in range(epochs):
            step = rate / (1 + epoch / 2)
            for cut, found, gold in prepared:
                n = len(cut)
                arcs = [(i, j, k, self.score(k, f), f) for i, j, f in found for k in KINDS]
                by_end: dict[int, list] = {}
                by_start: dict[int, list] = {}
                for arc in arcs:
                    by_end.setdefault(arc[1], []).append(arc)
                    by_start.setdefault(arc[0], []).append(arc)
                ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(n):
                    ahead[j + 1] = _log_sum([ahead[j], *[ahead[i] + s for i, _, _, s, _ in by_end.get(j, ())]])
                for i in range(n - 1, -1, -1):
                    behind[i] = _log_sum([behind[i + 1], *[s + behind[j + 1] for _, j, _, s, _ in by_start.get(i, ())]])
                for i, j, kind, s, features in arcs:
                    given = gold.get((cut[i][0], cut[j][1])) == kind
                    change = given - math.exp(min(0.0, ahead[i] + s + behind[j + 1] - ahead[n]))
                    if abs(change) > 1e-4:
                        for f in features:
                            w = self.weights.get((kind, f), 0.0)
                            self.weights[kind, f] = w + step * (change - decay * w)


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _rewritten(kind: str, text: str) -> list[str]:
    """Other ways to write a span of one kind, to learn from: same data, another spelling."""
    if kind == "email":
        return [text.replace("@", " [at] "), text.replace("@", "(at)")]
    if kind == "phone":
        return [text.lstrip("+"), re.sub(r"^\+\d+\s*", "", text)]
    if kind == "card":
        d = _digits(text)
        return [".".join(d[i:i + 4] for i in range(0, len(d), 4)), "/".join(d[i:i + 4] for i in range(0, len(d), 4))]
    return []


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and at signs, cut at white space; nothing outside can hold a segment."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    cut = []
    for a, b in out:
        while a > 0 and not text[a - 1].isspace() and a > b - 10_000:
            a -= 1
        while b < len(text) and not text[b].isspace() and b < a + 10_000:
            b += 1
        cut.append((a, b))
    return cut


def examples(text: str) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Training windows of one text: as it stands, and with each span spelt in other ways."""
    out = []
    for a, b in windows(text):
        piece = text[a:b][:600]
        gold = set(base_spans(piece))
        out.append((piece, gold))
        for kind, s, e in sorted(gold):
            for other in _rewritten(kind, piece[s:e]):
                changed = piece[:s] + other + piece[e:]
                spans = {x for x in base_spans(changed) if x[2] <= s or x[1] >= s + len(other)}
                out.append((changed, spans | {(kind, s, s + len(other))}))
    return out


def train(docs: DataFrame, key: str, text: str, sample: int = SAMPLE_DOCS) -> SpanModel:
    """Fit on at most ``sample`` documents with a base span and as many with digits but none, first by hash of the key."""
    value = F.col(text)
    marked = docs.where(value.rlike("[0-9]")).select(
        F.substring(value, 1, 20_000).alias("t"), F.xxhash64(F.col(key)).alias("h"),
        value.rlike(r"@[A-Za-z0-9-]+[.]|[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|[0-9]{13}|[+][0-9]").alias("has"))
    chosen = []
    for has in (True, False):
        chosen += [r["t"] for r in marked.where(F.col("has") == F.lit(has)).orderBy("h", "t").limit(sample // 4).select("t").collect()]
    model = SpanModel()
    model.fit([e for t in chosen for e in examples(t)[:12]][:sample])
    return model


def find_spans(docs: DataFrame, model: SpanModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every whole text: (key, spans array of (kind, start, end, base)), code points, end exclusive.

    Base spans stay. Spans of the model that overlap none of them are added. Null and empty texts have
    none. Repeated rows stay repeated. Other columns do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = []
            for value in batch.column(1):
                value = value.as_py() or ""
                base = base_spans(value)
                spans = [(k, s, e, True) for k, s, e in base]
                taken = sorted((s, e) for _, s, e in base)
                for a, b in windows(value):
                    for k, s, e in m.best(value, a, b):
                        if not any(s < y and x < e for x, y in taken if y > a and x < b):
                            spans.append((k, s, e, False))
                spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
                found.append([{"kind": k, "start": s, "end": e, "base": o} for k, s, e, o in spans])
            yield pa.record_batch([batch.column(0), pa.array(found, schema)], [key, "spans"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text)).mapInArrow(find, f"`{key}` {kind}, spans array<struct<kind string, start long, end long, base boolean>>")
