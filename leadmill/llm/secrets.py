"""Secret scans: rules for known forms, and a character convolutional network for every candidate.

Candidates are the findings of the rules and all other runs of at least 16 characters of the alphabet of
keys. The network, plain numpy, reads each candidate and 16 characters on both sides:
characters are embedded, convolved over five positions, and the largest responses inside and around
the candidate meet in one logistic unit. It learns from labelled findings: those the rules label, each as it
stands and spelled anew in another alphabet of keys and length without the word that gave it away, so that it
is the form of keys that is learnt; against other candidates that repeat few characters, hosts, paths and compound
words, ordinary words, words in capitals run together, and long numbers; all also with their surroundings blanked. All windows of all documents are learnt from: a first fit on a bounded number of windows
of either label, those of lowest hash, gives the start from which tasks go over shards of all different windows, and the mean of their networks is taken. A fifth of the texts is held out, with every
window that no other text has, so that neither a value nor the surroundings it was respelled in are learnt from, to calibrate the score (Platt
scaling by Newton steps, both labels weighing the same; outputs are counted in steps of 1/1024) and to set the threshold, which keeps the required recall there.

Rule findings always stay, with the network's score; other candidates over the threshold are added as `model`.
Finding is one narrow pass over whole texts.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import warnings
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, small_batches, spool

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A match of the plain pattern is one whole run, so its least length can be asked for at once.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}")
PART, WHOLE = re.compile(r"\S{8,}"), 1_000_000  # texts beyond are not split at once
LETTERS = re.compile(r"[^\W\d_]+")
ALPHABETS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEF",
    "0123456789abcdef",
)

CONTEXT, BODY = 16, 64
WIDTH = BODY + 2 * CONTEXT
INSIDE = slice(CONTEXT - 2, CONTEXT + BODY - 2)  # places of the convolution amid the candidate
KEY_LIKE = 3.8
RESPELLED = 16  # new spellings of each finding
OTHER, PAD = 96, 97
LEAST = 20  # windows of either label to learn from
SHARD = 100_000  # windows that one task learns from
FEW = 1000  # windows of a label below which a shard takes those of the first fit too
GRID = 1024  # steps of one in which outputs of held-out windows are counted


def parts(text: str) -> list[tuple[int, str]]:
    """What stands between white space, from eight characters on, with its start: keys and long words have none inside, so most of a text is
    not looked at again."""
    if len(text) > WHOLE:
        return [(m.start(), m[0]) for m in PART.finditer(text)]
    out, at = [], 0
    for part in [p for p in text.split() if len(p) >= 8]:
        at = text.find(part, at)  # first after the long part before, as it could only lie within one
        out.append((at, part))
        at += len(part)
    return out


def rule_spans(text: str, among: list[tuple[int, str]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules' findings, by start, then kind as listed; `among` are the text's parts."""
    spans, among = [], parts(text) if among is None else among
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for at, part in among if len(part) >= 32 for m in HEX.finditer(text, at, at + len(part))]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, spans: list[tuple[int, int, str]], among: list[tuple[int, str]] | None = None) -> list[tuple[int, int]]:
    """Runs that overlap no rule finding; `among` are the text's parts."""
    out, at = [], 0
    ends = np.maximum.accumulate([e for _, e, _ in spans]) if spans else []
    starts = [s for s, _, _ in spans]
    among = parts(text) if among is None else among
    for a, b in (m.span() for begin, part in among if len(part) >= 16 for m in RUN.finditer(text, begin, begin + len(part))):
        while at < len(starts) and starts[at] < b:
            at += 1
        if at == 0 or ends[at - 1] <= a:
            out.append((a, b))
    return out


def windows(text: str, a: int, b: int) -> list[str]:
    """The candidate with its surroundings, in as many windows as its length takes."""
    out = []
    for at in range(a, b, BODY):
        end = min(b, at + BODY)
        body = text[at:end].ljust(BODY, "\0")
        out.append(text[max(0, at - CONTEXT) : at].rjust(CONTEXT, "\0") + body + text[end : end + CONTEXT].ljust(CONTEXT, "\0"))
    return out


def codes(texts: list[str]) -> np.ndarray:
    """Windows as codes: printable ASCII by itself, others as one, padding as one."""
    x = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), WIDTH).astype(np.int64)
    return np.where(x == 0, PAD, np.where((x >= 32) & (x < 127), x - 32, OTHER))


@dataclass
class CharCnn:
    """Embedding, convolution of width five, largest responses inside and around, logistic unit."""

    seed: int = 7
    dim: int = 8
    filters: int = 16
    span: int = 5
    params: dict = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = float("inf")
    recall: float = float("nan")  # of held-out secrets
    false_alarms: float = float("nan")  # share of other held-out windows over the threshold

    def start(self) -> None:
        r = np.random.default_rng(self.seed)
        self.params = {
            "e": r.normal(0, 0.3, (PAD + 1, self.dim)),
            "k": r.normal(0, (self.span * self.dim) ** -0.5, (self.span * self.dim, self.filters)),
            "c": np.zeros(self.filters),
            "w": r.normal(0, 0.1, 2 * self.filters),
            "b": np.zeros(1),
        }

    def responses(self, x: np.ndarray) -> np.ndarray:
        """row, place, filter: the convolution, each code's part in each tap looked up."""
        p, out = self.params, WIDTH - self.span + 1
        parts = np.einsum("cd,tdf->tcf", p["e"], p["k"].reshape(self.span, self.dim, self.filters))
        x = np.asarray(x, np.intp)  # once for all taps
        h = np.take(parts[0], x[:, :out], axis=0, mode="clip")
        more = np.empty_like(h)
        for tap in range(1, self.span):
            h += np.take(parts[tap], x[:, tap : tap + out], axis=0, out=more, mode="clip")
        return h

    def forward(self, x: np.ndarray, keep: bool = False):
        p, h = self.params, self.responses(x)
        if not keep:
            around = np.maximum(h[:, : INSIDE.start].max(axis=1), h[:, INSIDE.stop :].max(axis=1))
            return np.maximum(np.hstack([h[:, INSIDE].max(axis=1) + p["c"], around + p["c"]]), 0) @ p["w"] + p["b"][0]
        around = np.r_[0 : INSIDE.start, INSIDE.stop : h.shape[1]]
        at = np.stack([h[:, INSIDE].argmax(axis=1) + INSIDE.start, around[h[:, around].argmax(axis=1)]], axis=1)  # row, side, filter
        top = np.maximum(h[np.arange(len(x))[:, None, None], at, np.arange(self.filters)] + p["c"], 0)
        return top.reshape(len(x), -1) @ p["w"] + p["b"][0], (at, top)

    def gradients(self, x: np.ndarray, z: np.ndarray, y: np.ndarray, kept, weight: np.ndarray | None = None) -> dict:
        """Of the logistic loss, by default of the mean; only the places of the largest responses have any."""
        (at, top), p, f = kept, self.params, np.arange(self.filters)
        i, flat = np.arange(len(x))[:, None, None], top.reshape(len(x), -1)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * (1 / len(x) if weight is None else weight)
        back = g[:, None, None] * p["w"].reshape(2, self.filters) * (top > 0)
        taps = np.arange(self.span)
        seen = (taps * (PAD + 1) + x[i[..., None], at[..., None] + taps]) * self.filters + f[:, None]
        parts = np.bincount(seen.ravel(), np.broadcast_to(back[..., None], seen.shape).ravel(), self.span * (PAD + 1) * self.filters).reshape(self.span, PAD + 1, self.filters)
        k = p["k"].reshape(self.span, self.dim, self.filters)
        of_k = np.einsum("cd,tcf->tdf", p["e"], parts).reshape(p["k"].shape)
        return {"w": flat.T @ g + 1e-4 * p["w"], "b": np.array([g.sum()]), "c": back.sum(axis=(0, 1)), "k": of_k, "e": np.einsum("tcf,tdf->cd", parts, k)}

    def descend(self, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], rates: Iterator[float]) -> None:
        """Adam on the logistic loss over batches of windows, labels and weights."""
        moment = {k: np.zeros_like(v) for k, v in self.params.items()}
        square = {k: np.zeros_like(v) for k, v in self.params.items()}
        for step, (batch, rate) in enumerate(zip(batches, rates), 1):
            x, y, weight = batch
            z, kept = self.forward(x, keep=True)
            for k, g in self.gradients(x, z, y, kept, weight).items():
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                self.params[k] = self.params[k] - rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> None:
        """From the start; rare labels count as much as frequent ones."""
        self.start()
        r = np.random.default_rng(self.seed)
        pos, neg = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        picks = (np.concatenate([r.choice(pos, batch // 2), r.choice(neg, batch // 2)]) for _ in range(epochs * max(10, len(y) // batch)))
        self.descend(((x[pick], y[pick], np.full(len(pick), 1 / len(pick))) for pick in picks), itertools.repeat(rate))

    def go_over(self, x: np.ndarray, y: np.ndarray, batch: tuple[int, int] = (192, 64), rate: float = 0.003) -> None:
        """Once over all windows, those of the label that ends first again, both labels weighing the same, at a rate that falls to 0."""
        of = [np.flatnonzero(y == k) for k in (0, 1)]
        steps = max(-(-len(own) // size) for own, size in zip(of, batch))

        def batches():
            for at in range(steps):
                pick = [np.take(own, np.arange(at * size, (at + 1) * size), mode="wrap") for own, size in zip(of, batch)]
                both = np.concatenate(pick)
                yield x[both], y[both], np.repeat(0.5 / np.array(batch), batch)

        self.descend(batches(), (rate * (1 - at / steps) for at in range(steps)))

    def calibrate(self, z: np.ndarray, y: np.ndarray, count: np.ndarray, recall: float) -> None:
        """Platt scaling of held-out outputs, each `count` times, with both labels weighing the same, then the threshold that
        keeps `recall` of the held-out secrets: between the score that does so just and the next lower
        one of a held-out other text, which costs no further false alarm there."""
        z, n = np.clip(z, -30, 30), np.array([count[y == 0].sum(), count[y == 1].sum()])
        weight = count * 0.5 / n[y]
        target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
        a, w = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + 1e-9 * np.eye(2), a.T @ (weight * (target - p)))
            w += np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.scale, self.shift = float(w[0]), float(w[1])
        score = self.scaled(z)
        order = np.argsort(score[y == 1])
        upto = np.cumsum(count[y == 1][order])
        at = float(score[y == 1][order][np.searchsorted(upto, int((1 - recall) * n[1]), side="right")])
        below = score[(y == 0) & (score < at)].max(initial=0.0)
        self.threshold = (at + float(below)) / 2
        self.recall, self.false_alarms = (float(count[(y == k) & (score >= self.threshold)].sum() / n[k]) for k in (1, 0))

    def scores_raw(self, x: np.ndarray, block: int = 256) -> np.ndarray:
        return np.concatenate([self.forward(x[i : i + block]) for i in range(0, len(x), block)]) if len(x) else np.zeros(0)

    def scaled(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(self.scores_raw(x))


def entropy(run: str) -> float:
    """Bits a character."""
    n = np.array(list(Counter(run).values())) / len(run)
    return float(-(n * np.log2(n)).sum())


def respelled(value: str, nth: int) -> str:
    """Another key: 16 to 64 characters of an alphabet, all decided by the hash of `value` and `nth`."""
    r = b"".join(hashlib.blake2b(bytes([nth, k]) + value.encode("utf-8", "surrogatepass")).digest() for k in (0, 1))
    letters = ALPHABETS[r[0] % len(ALPHABETS)]
    return "".join(letters[b % len(letters)] for b in r[2 : 18 + r[1] % 49])


def of_words(run: str) -> bool:
    """Whether the run is a host, a path or a compound: parts that are words or short numbers."""
    return all(WORD.fullmatch(p) for p in re.split(r"[+/_.=-]+", run) if p)


def bare(window: str) -> str:
    return "\0" * CONTEXT + window[CONTEXT:-CONTEXT] + "\0" * CONTEXT


def plain(run: str) -> bool:
    """Whether a candidate is no key by its form: repeated characters, hosts, paths, compounds, capitals with marks at their end, numbers."""
    return entropy(run) < KEY_LIKE or of_words(run) or run.isdigit() or of_words(run.rstrip("._=-+/"))


def labelled(text: str) -> Iterator[tuple[str, int]]:
    """Windows of a text with labels, each also without its surroundings: rule findings (as they stand, and
    spelled anew amid what stands around them) are secrets; other candidates that are plain, each eighth long word, and such words in capitals run
    together or with their lengths as digits, are not. Other candidates may be secrets that no rule names: they have no label."""
    among = parts(text)
    spans = rule_spans(text, among)
    for start, b, kind in spans:
        a = ASSIGN.match(text, start).start(2) if kind == "assign" else start
        for w in windows(text, a, b):
            yield w, 1
            yield bare(w), 1
        if kind == "hex" and any(x < b and start < y for x, y, k in spans if k == "assign"):
            continue  # the assignment's own key
        before, after = text[max(0, start - CONTEXT) : start].rstrip() + " ", " " + text[b : b + CONTEXT].lstrip("\"' ")
        for nth in range(RESPELLED):
            key = respelled(text[a:b], nth)
            w = windows(before + key + after, len(before), len(before) + len(key))[0]
            yield w, 1
            yield bare(w), 1
    for a, b in candidates(text, spans, among):
        if plain(text[a:b]):
            for w in windows(text, a, b):
                yield w, 0
                yield bare(w), 0
    last, long = "", ((at, part) for at, part in among if len(part) <= 64 and (part.isalpha() or LETTERS.fullmatch(part)))
    for n, (at, word) in enumerate(long):
        if n % 8 == 0:
            end = at + len(word)
            w = windows(text, at, end)[0]
            yield w, 0
            yield bare(w), 0
            # Forms that prose takes in headings and tables.
            before, after = text[max(0, at - CONTEXT) : at], text[end : end + CONTEXT]
            loud = (word + last).upper()[:BODY] + ".,;:"[n // 8 % 4] * (n // 32 % 2)
            number = str(zlib.crc32(word.encode()) ** 3)[: 16 + n // 8 % 12]
            for form in (loud, number):
                w = windows(before + form + after, len(before), len(before) + len(form))[0]
                yield w, 0
                yield bare(w), 0
        last = word


def lowest(found: dict[tuple[str, int], tuple[int, bool]], most: int) -> dict[tuple[str, int], tuple[int, bool]]:
    """Of each label the `most` windows of lowest hash."""
    out = {}
    for label in (0, 1):
        out |= sorted((x for x in found.items() if x[0][1] == label), key=lambda x: (x[1][0], x[0]))[:most]
    return out


def is_held(text: str) -> bool:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % 5 == 0


def drawn(docs: DataFrame, most: int) -> tuple[pd.DataFrame, int]:
    """w, y, held: of each label the `most` different windows of the texts (t) whose hashes are lowest; held are those of held-out texts that no
    other text has. Each task sends no more than these of its own. And the number of all windows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, int], tuple[int, bool]] = {}
        bound, n = [1 << 64, 1 << 64], 0
        for batch in batches:
            for text in batch["t"]:
                held = is_held(text)
                for w, y in labelled(text):
                    n += 1
                    o = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
                    if o <= bound[y]:
                        found[w, y] = o, held and found.get((w, y), (o, True))[1]
            if len(found) > 4 * most:
                found = lowest(found, most)
                for y in (0, 1):
                    mine = [o for (_, label), (o, _) in found.items() if label == y]
                    bound[y] = max(mine) if len(mine) == most else 1 << 64
        found = lowest(found, most)
        # The high bit of o is turned, so that signed order is that of the hashes.
        yield pd.DataFrame({"w": pd.Series([w.replace("\0", "\x7f") for w, _ in found], dtype=object), "y": np.array([y for _, y in found], np.int32), "o": np.array([o - (1 << 63) for o, _ in found.values()], np.int64), "held": np.array([h for _, h in found.values()], bool), "n": 0})
        yield pd.DataFrame({"w": [None], "y": [-1], "o": [0], "held": [False], "n": [n]})

    every = spool(map_texts(docs, run, "w string, y int, o long, held boolean, n long"), "windows")
    rows = every.filter("y >= 0").groupBy("w", "y", "o").agg(F.min("held").alias("held"))
    got = pd.concat([rows.filter(F.col("y") == k).orderBy("o", "w").limit(most).toPandas() for k in (0, 1)], ignore_index=True)
    got["w"] = got["w"].str.replace("\x7f", "\0", regex=False)
    return got, every.agg(F.sum("n")).first()[0] or 0


def sample(docs: DataFrame, most: int) -> pd.DataFrame:
    """The windows of `drawn`."""
    return drawn(docs, most)[0]


def hashed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """64-bit hashes of windows (codes of a byte) with their labels."""
    h = y.astype(np.uint64)
    for part in np.ascontiguousarray(x).view(np.uint64).T:
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def by_hash(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)) % np.uint64(5) == 0


def once(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different windows with labels, by hash, and the hashes; held are those that are held wherever they stand."""
    h = hashed(x, y)
    order = np.lexsort((held, h))
    order = order[np.append(True, h[order][1:] != h[order][:-1])] if len(order) else order
    return x[order], y[order], held[order], h[order]


def dealt(docs: DataFrame, shards: int, by: str) -> DataFrame:
    """shard, x, y, held: all windows of the texts (t) by their hashes, in packed rows. Held out are windows of held-out texts, or `by` "value" or "hash"
    those of some values or hashes. A task deals a text once, however often it has it."""
    flush = min(400_000, max(50_000, 64 * shards))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        parts, fresh, size = [], ([], [], []), 0

        def settle() -> None:
            if fresh[0]:
                parts.append((codes(fresh[0]).astype(np.uint8), np.array(fresh[1], np.uint8), np.array(fresh[2], bool)))
                for one in fresh:
                    one.clear()

        def out() -> pd.DataFrame:
            x, y, held, h = once(*(np.concatenate(p) for p in zip(*parts)))
            shard = (h % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(shard[order])) + 1, len(order))
            cuts = [order[a:b] for a, b in zip(np.append(0, ends[:-1]), ends)]
            return pd.DataFrame({"shard": [int(shard[c[0]]) for c in cuts], "x": [x[c].tobytes() for c in cuts], "y": [y[c].tobytes() for c in cuts], "held": [held[c].tobytes() for c in cuts]})

        for batch in batches:
            for text in batch["t"]:
                name = hash(text)
                if name in done:
                    continue
                if len(done) >= 1_000_000:
                    done.clear()
                done.add(name)
                own = is_held(text)
                for w, y in labelled(text):
                    fresh[0].append(w)
                    fresh[1].append(y)
                    fresh[2].append(own if by == "text" else is_held(w[CONTEXT:-CONTEXT]))
                    if len(fresh[0]) >= 4096:
                        size += len(fresh[0])
                        settle()
                        if size >= flush:
                            yield out()
                            parts, size = [], 0
        settle()
        if parts:
            yield out()

    return map_texts(docs, run, "shard int, x binary, y binary, held binary")


def shard_fit(model: CharCnn, first: tuple[np.ndarray, np.ndarray], by: str):
    """Of a shard (rows of `dealt`): the network after going over its windows from `model` on, with their number, and its held-out windows. Where it
    has few of a label, the windows of the first fit go with them."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        whole = (b"".join(part[c]) for c in ("x", "y", "held"))
        x, y, held = (np.frombuffer(b, kind) for b, kind in zip(whole, (np.uint8, np.uint8, bool)))
        x, y, held, h = once(x.reshape(-1, WIDTH), y, held)
        if by == "hash":
            held = by_hash(h)
        mine, own = (x[~held], y[~held]), CharCnn(params=dict(model.params))
        for k in (0, 1):
            if (y[~held] == k).sum() < FEW:
                mine = tuple(np.concatenate([a, b[first[1] == k]]) for a, b in zip(mine, first))
        own.go_over(*mine)
        flat = np.concatenate([own.params[k].ravel() for k in sorted(own.params)])
        cuts = [slice(at, at + 20_000) for at in range(0, int(held.sum()), 20_000)]
        rows = [(int((~held).sum()), flat.tolist(), None, None)] + [(0, None, x[held][c].tobytes(), y[held][c].tobytes()) for c in cuts]
        return pd.DataFrame(rows, columns=["n", "params", "x", "y"])

    return run


def fit_all(docs: DataFrame, n: int, model: CharCnn, first: tuple[np.ndarray, np.ndarray], by: str, recall: float) -> None:
    """Fits `model` on, over all windows of the texts (t): every shard goes over its own, and the networks' mean, each by its number of windows, is taken.
    All held-out windows calibrate it."""
    shards = -(-n // SHARD)
    rows = dealt(docs, shards, by).repartition(shards, "shard").groupBy("shard").applyInPandas(shard_fit(model, first, by), "n long, params array<double>, x binary, y binary")
    rows = spool(rows, "shards")
    mean = rows.filter("n > 0").select("n", F.posexplode("params")).groupBy("pos").agg((F.sum(F.col("n") * F.col("col")) / F.sum("n")).alias("mean"))
    flat, at = mean.orderBy("pos").toPandas()["mean"].to_numpy(float), 0
    for k in sorted(model.params):
        size = model.params[k].size
        model.params[k] = flat[at : at + size].reshape(model.params[k].shape)
        at += size

    def outputs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"]):
                z = model.scores_raw(np.frombuffer(x, np.uint8).reshape(-1, WIDTH))
                got = pd.DataFrame({"z": np.rint(np.clip(z, -30, 30) * GRID).astype(np.int64), "y": np.frombuffer(y, np.uint8).astype(np.int64)})
                yield got.groupby(["z", "y"]).size().rename("n").reset_index()

    held = map_texts(rows.filter("x is not null").select("x", "y"), outputs, "z long, y long, n long").groupBy("z", "y").agg(F.sum("n").alias("n")).orderBy("z", "y").toPandas()
    model.calibrate(held["z"].to_numpy(float) / GRID, held["y"].to_numpy(np.int64), held["n"].to_numpy(float), recall)


def train(docs: DataFrame, *, text_col: str, sample_windows: int = 20_000, recall: float = 0.95) -> CharCnn | None:
    """The network, fitted on all windows of all documents: first on up to `sample_windows` of them, up to half of them of
    either label, then, where there are more, in shards over all. None, with a warning, where the documents hold under LEAST windows of one: there is nothing to learn from. Where held-out or other
    texts lack a label, windows are held out by their value instead."""
    texts, most = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t")), sample_windows // 2
    got, n = drawn(texts, most)
    y, held, by = got["y"].to_numpy(), got["held"].to_numpy(bool), "text"
    if (y == 1).sum() < LEAST or (y == 0).sum() < LEAST:
        warnings.warn(f"fewer than {LEAST} windows of findings or of other text: only the rules find", stacklevel=2)
        return None
    x, more = codes(got["w"].tolist()), max((y == 0).sum(), (y == 1).sum()) >= most
    if min(len(set(y[held])), len(set(y[~held]))) < 2:
        held, by = np.array([is_held(w[CONTEXT:-CONTEXT]) for w in got["w"]]), "value"
        if min(len(set(y[held])), len(set(y[~held]))) < 2:
            held, by = by_hash(hashed(x.astype(np.uint8), y)) if more else got.groupby("y").cumcount().to_numpy() % 5 == 0, "hash"
    model = CharCnn()
    model.fit(x[~held], y[~held])
    if not more:
        model.calibrate(model.scores_raw(x[held]), y[held], np.ones(held.sum()), recall)
    else:
        fit_all(texts, n, model, (x[~held].astype(np.uint8), y[~held].astype(np.uint8)), by, recall)
    return model


def scored(texts: list[str], spans: list[list[tuple[int, int, str]]], model: CharCnn | None, among: list[list[tuple[int, str]]] | None = None) -> tuple[list[list[float]], list[list[tuple[int, int, float]]]]:
    """For each text the scores of its rule findings, and the other candidates that the network takes for
    secrets with theirs."""
    of_rules: list[list[float]] = [[0.0] * len(s) for s in spans]
    more: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    if model is None:
        return of_rules, more
    held: list[str] = []
    whose: list[tuple[int, int, int, int]] = []

    def settle():
        best: dict[tuple[int, int, int, int], float] = {}
        for key, s in zip(whose, model.scores(codes(held)) if held else ()):
            best[key] = max(best.get(key, 0.0), float(s))
        for (i, n, a, b), s in best.items():
            if n >= 0:
                of_rules[i][n] = max(of_rules[i][n], s)
            elif s >= model.threshold:
                more[i].append((a, b, s))
        held.clear()
        whose.clear()

    for i, text in enumerate(texts):
        own = parts(text) if among is None else among[i]
        rules = ((n, ASSIGN.match(text, a).start(2) if k == "assign" else a, b) for n, (a, b, k) in enumerate(spans[i]))
        for n, a, b in [*rules, *((-1, a, b) for a, b in candidates(text, spans[i], own))]:
            w = windows(text, a, b)
            held += w
            whose += [(i, n, a, b)] * len(w)
            if len(held) >= 4096:
                settle()
    settle()
    return of_rules, more


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.95, model: CharCnn | None = None) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, n_model, base_sha256, spans, scores.

    `spans` lists kind:start:end by start, then kind (assign, access, hex, model), in code points,
    ends exclusive; `scores` has the network's score of each, in the same order; `base_sha256` hashes the rules' part of
    the spans. A null or empty text has no spans and
    the hash of the empty string. Rows are independent: null or repeated ids stay, one row each. Only
    the two named columns are read; an empty table gives no rows; texts are scanned whole. `model` is a
    network from `train`; without one it is fitted here. With fewer than LEAST windows of findings or of other
    text in all documents no network is fitted, only the rules find, scores are 0, and a warning says so.
    """
    model = model or train(docs, text_col=text_col, recall=recall)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["t"].tolist()
            among = [parts(t) for t in texts]
            spans = list(map(rule_spans, texts, among))
            rows = []
            for mine, own, more in zip(spans, *scored(texts, spans, model, among)):
                base = ",".join(f"{k}:{a}:{b}" for a, b, k in mine)
                every = [(a, b, k, s) for (a, b, k), s in zip(mine, own)] + [(a, b, "model", s) for a, b, s in more]
                every.sort(key=lambda s: (s[0], (*KINDS, "model").index(s[2])))
                n = [sum(s[2] == k for s in mine) for k in KINDS]
                rows.append((*n, len(more), hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k, _ in every), ",".join(f"{s:.3f}" for *_, s in every)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans", "scores"])
            out.insert(0, "id", batch["i"].astype("Int64"))
            yield out

    source = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return map_texts(source, run, "id long, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string, scores string").withColumnRenamed("id", id_col)


def redact_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.95, mask: str = "[secret]", model: CharCnn | None = None) -> DataFrame:
    """The rows with every found secret (of an assignment only its value) replaced by `mask`.

    All rows and columns stay; texts without findings, null and empty ones are unchanged.
    """
    model = model or train(docs, text_col=text_col, recall=recall)

    def clean(column: pd.Series) -> pd.Series:
        texts = [t if isinstance(t, str) else "" for t in column]
        among = [parts(t) for t in texts]
        spans = list(map(rule_spans, texts, among))
        out = []
        for old, text, mine, more in zip(column, texts, spans, scored(texts, spans, model, among)[1]):
            cuts = [(ASSIGN.match(text, a).start(2) if k == "assign" else a, b) for a, b, k in mine] + [(a, b) for a, b, _ in more]
            rest, at = [], 0
            for a, b in sorted(cuts):
                if a >= at:
                    rest += [text[at:a], mask]
                at = max(at, b)
            out.append("".join([*rest, text[at:]]) if cuts else old)
        return pd.Series(out, dtype=object)

    small_batches(docs.sparkSession)
    mark = F.pandas_udf(clean, "string")
    return docs.select(*(mark(F.col(f"`{c}`").cast("string")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
