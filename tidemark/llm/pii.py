"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

Only words with a digit or an @ can be personal data of the four kinds; every other word has the
label "none" for certain, which cuts the chain of a document into short pieces. The random field
is over the remaining words: node potentials from features of the word and its neighbours, chain
potentials between words that stand side by side, and skip potentials between words of a
document that are equal, or share their last digits, however far apart (a number written with
spaces counts as a whole: all its words share its last digits): three and more like words
hang on one hub variable, so any two of them are two hops apart however many there are. Loopy
sum-product message passing on that graph, until a document's messages settle, makes the labels of
such words agree; a word whose marginal for a kind reaches MIN_MARGINAL and that no base span
touches gives an added span.

The weights are fitted by pseudo-likelihood on a bounded sample: the SAMPLE documents with the
smallest hashes among those with a digit or an @ and at most SAMPLE_CHARS characters, labelled by
the base patterns; so the driver gets the features of SAMPLE * SAMPLE_CHARS / 2 words at most.
Everything else covers all documents and whole texts.

Edge cases: a NULL or empty text has no spans; repeated rows and NULL ids give a result row each;
an empty table gives an empty result (and no fit); other columns are ignored. All scans are linear in the text, also for long runs without white space.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, narrow, smallest

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
SAMPLE, SAMPLE_CHARS = 3000, 20_000
MIN_MARGINAL = 0.9
FEATURES = 1 << 12            # buckets the features are hashed to
PER_WORD = 9                  # features of a word
ROUNDS = 1000                 # where the messages of a document never settle
SETTLED = 1e-5                # largest change of a message that counts as none
AGREE = 3.0
LIKE = 7                      # least length, and last digits compared, of like words
MOST = 19                     # digits of the longest number

_ANY = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SPACE = re.compile(r"\s")
_WORD = re.compile(r"\S+")
_DIGITS = re.compile(r"[^0-9]+")
_PLAIN = re.compile(r"\+?[0-9][0-9().-]*")          # a word of a number written with spaces, and what may
_GAP = re.compile(r"[()]*[\x20\t\xa0]{1,2}[()]*")     # stand between two of them


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns, leftmost and non-overlapping per kind."""
    if not _ANY.search(text):
        return []
    out = []
    after, at = 0, text.find("@")
    while at >= 0:                 # an address has one @: its name is the run of name characters before it
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            after = m.end()
        at = text.find("@", max(at + 1, after))
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts[i:i + 4]):
                start = m.start() + sum(len(p) + 1 for p in parts[:i])
                out.append((start, 1, start + len(".".join(parts[i:i + 4]))))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


_EDGE = "\"'.,;:!?()[]{}<>|#*$%&"


def live_words(text: str) -> Iterator[tuple[int, int]]:
    """Words with a digit or an @, without punctuation at their ends."""
    pos = 0
    while m := _ANY.search(text, pos):
        start = m.start()
        while start > pos and not text[start - 1].isspace():
            start -= 1
        end = _SPACE.search(text, m.end())
        pos = end = end.start() if end else len(text)
        word = text[start:end]
        core = word.strip(_EDGE)
        if core:
            start += word.index(core)
            yield start, start + len(core)


def _neighbours(text: str, start: int, end: int) -> tuple[str, str]:
    """The whole words before and after. A word is looked at by two others at most."""
    hi = start
    if hi and not text[hi - 1].isspace():         # punctuation before the word
        while hi and not text[hi - 1].isspace():
            hi -= 1
        before = text[hi:start]
    else:
        while hi and text[hi - 1].isspace():
            hi -= 1
        lo = hi
        while lo and not text[lo - 1].isspace():
            lo -= 1
        before = text[lo:hi]
    word = _WORD.search(text, end)
    return before.lower(), word[0].lower() if word else ""


def features(text: str, start: int, end: int) -> list[int]:
    """Hashed binary features of a word and its neighbours."""
    word = text[start:end]
    digits = len(_DIGITS.sub("", word))
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", word)))[:40]
    before, after = _neighbours(text, start, end)
    out = ["bias", f"s{shape}", f"d{min(digits, 24)}", f"l{min(len(word), 30) // 3}", f"at{word.count('@')}",
           f"dot{min(word.count('.'), 5)}", f"plus{text[max(0, start - 1):start + 1].count('+')}",
           f"p{before.strip(_EDGE)}", f"n{after.strip(_EDGE)}"]
    return [zlib.crc32(f.encode()) % FEATURES for f in out]


def _last_words(run: list[int], digits: list[str], most: int) -> int:
    """How many words at the end of a run have at least LIKE digits, and beyond that at most `most`."""
    n, total = 0, 0
    while n < len(run) and (total < LIKE or total + len(digits[-1 - n]) <= most):
        total += len(digits[-1 - n])
        n += 1
    return n if total >= LIKE else 0


def spaced(text: str, own: list[tuple[int, int, int]], base: list[tuple[int, int, int]]):
    """(words, digits) of the numbers of a text that are written in several words: the words that a
    base span covers, and at each end in a run of digit words side by side the last words, up to
    MOST digits. `own` has (word, start, end) in order. Linear in the words."""
    numbers, at, covered = [], 0, set()
    for s, k, e in sorted(x for x in base if x[1] > 1):          # cards and phones
        while at < len(own) and own[at][2] <= s:
            at += 1
        under, j = [], at
        while j < len(own) and own[j][1] < e:
            under.append(own[j][0])
            j += 1
        digits = _DIGITS.sub("", text[s:e])
        if len(under) > 1 and len(digits) >= LIKE:
            numbers.append((under, [digits], True))
            covered.update(under)
    run, parts, last = [], [], 0
    for i, start, end in own:
        plain = _PLAIN.fullmatch(text, start, end) and i not in covered
        if not plain or run and not _GAP.fullmatch(text, last, start):
            run, parts = [], []
        if plain:
            run.append(i)
            parts.append(_DIGITS.sub("", text[start:end]))
            n = _last_words(run, parts, MOST)
            if n > 1:
                numbers.append((run[-n:], parts[-n:], False))
            run, parts, last = run[-MOST:], parts[-MOST:], end
    return numbers


def _common(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def agreed(numbers) -> list[int]:
    """The words that numbers with the same last digits share: all words of a base span or of one word, and
    of a run those whose digits end another of the numbers too."""
    order = sorted(("".join(parts)[::-1], i) for i, (_, parts, _) in enumerate(numbers))
    out = set()
    for at, (mine, i) in enumerate(order):
        run, parts, whole = numbers[i]
        near = [order[j][0] for j in (at - 1, at + 1) if 0 <= j < len(order)]       # neighbours share the most
        out.update(run if whole else run[-_last_words(run, parts, max(_common(mine, x) for x in near)):])
    return sorted(out)


def graph(texts: list[str], base: list[list[tuple[int, int, int]]]):
    """Live words of all texts: (text, start, end), features, chain edges and groups of like words."""
    words, feats, chain, groups = [], [], [], []
    for t, text in enumerate(texts):
        last_end, like, numbers, first = -2, {}, {}, len(words)
        for start, end in live_words(text):
            i = len(words)
            word = text[start:end]
            if 0 <= last_end and start - last_end <= 3 and i:
                chain.append((i - 1, i))
            digits = _DIGITS.sub("", word)
            if len(digits) >= LIKE:           # equal words have equal last digits
                numbers.setdefault(digits[-LIKE:], []).append(([i], [digits], True))
            elif len(word) >= LIKE or 0 < word.find("@") < len(word) - 1:       # other short words are alike by chance
                like.setdefault(word.lower(), []).append(i)
            words.append((t, start, end))
            feats.append(features(text, start, end))
            last_end = end
        for number in spaced(text, [(i, *words[i][1:]) for i in range(first, len(words))], base[t]):
            numbers.setdefault("".join(number[1])[-LIKE:], []).append(number)
        same = [*like.values(), *(agreed(n) for n in numbers.values() if len(n) > 1)]
        groups += [list(g) for g in dict.fromkeys(map(tuple, same)) if len(g) > 1]
    return words, np.array(feats, np.int64).reshape(len(words), PER_WORD), chain, groups


def paths(groups: list[list[int]]) -> list[tuple[int, int]]:
    """Each like word with the last one before it: the skip edges of the fit, where labels are known."""
    return [e for g in groups for e in zip(g, g[1:])]


def ties(groups: list[list[int]], n: int, skip: np.ndarray):
    """Skip edges with their log potentials, and the number of hubs: two like words directly, more through
    a hub each, numbered from n. A tie to a hub is half a skip: two in a row are as strong as one."""
    both = np.exp((skip + skip.T) / 2)
    value, vector = np.linalg.eigh(both)
    half = np.log(np.maximum((vector * np.sqrt(np.maximum(value, 0))) @ vector.T, 1e-9))
    edges, direct, hubs = [], [], 0
    for g in groups:
        if len(g) == 2:
            edges.append(tuple(g))
            direct.append(True)
        else:
            edges += [(i, n + hubs) for i in g]
            direct += [False] * len(g)
            hubs += 1
    pots = np.where(np.array(direct, bool)[:, None, None], skip, half)
    return edges, pots, hubs


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def marginals(node: np.ndarray, edges: np.ndarray, pair: np.ndarray, rounds: int = ROUNDS,
              part: np.ndarray | None = None) -> np.ndarray:
    """Loopy sum-product: node (n, L) and pair (e, L, L) log potentials; the marginals (n, L). `part` numbers
    the parts (texts) the edges belong to; each runs until its own messages settle, whatever the others."""
    belief = node.copy()
    if len(edges):
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        pots = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        part = np.zeros(len(src), np.int64) if part is None else np.concatenate([part, part])
        msg = np.zeros((len(src), node.shape[1]))
        live = np.arange(len(src))
        for _ in range(rounds):
            new = _lse((belief[src[live]] - msg[back[live]])[:, :, None] + pots, 1)
            new -= _lse(new, 1)[:, None]
            step = 0.5 * (new - msg[live])
            msg[live] += step
            belief[dst[live]] = node[dst[live]]
            np.add.at(belief, dst[live], msg[live])
            moved = np.zeros(part.max() + 1)
            np.maximum.at(moved, part[live], np.abs(step).max(1))
            on = moved[part[live]] > SETTLED
            if not on.all():
                live, pots = live[on], pots[on]
            if not len(live):
                break
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(words, feats, chain, skip, gold: np.ndarray, steps: int = 300, rate: float = 0.5):
    """Weights by pseudo-likelihood: each word's label given its features and its neighbours'
    labels, gradient steps scaled per parameter. The base patterns label from afar: a word that they
    miss, but that is tied to one they found, is no example of "none" and is left out of the loss. Like words are held to agree: the skip potentials
    are pulled to AGREE for equal labels, all others to 0."""
    n_labels = len(LABELS)
    agree = AGREE * np.eye(n_labels)
    params = [np.zeros((FEATURES, n_labels)), np.zeros((n_labels, n_labels)), agree.copy()]
    scale = [np.full(p.shape, 1e-6) for p in params]
    want = np.eye(n_labels)[gold]
    found = gold > 0
    for a, b in [*skip, *reversed(list(skip))]:
        found[a] = found[b] = found[a] | found[b]
    counts = ((gold > 0) | ~found)[:, None]
    pairs = [(k, np.array(e, np.int64).reshape(-1, 2)) for k, e in ((1, chain), (2, skip))]
    for _ in range(steps if len(words) else 0):
        score = params[0][feats].sum(1)
        for k, e in pairs:
            np.add.at(score, e[:, 0], params[k].T[gold[e[:, 1]]])
            np.add.at(score, e[:, 1], params[k][gold[e[:, 0]]])
        p = np.exp(score - score.max(1, keepdims=True))
        off = (p / p.sum(1, keepdims=True) - want) * counts / len(words)
        grads = [1e-5 * params[0], 1e-3 * params[1], 1e-3 * (params[2] - agree)]
        for f in range(feats.shape[1]):
            np.add.at(grads[0], feats[:, f], off)
        for k, e in pairs:
            np.add.at(grads[k], gold[e[:, 0]], off[e[:, 1]])
            np.add.at(grads[k].T, gold[e[:, 1]], off[e[:, 0]])
        for p_, g, s in zip(params, grads, scale):
            s += g * g
            p_ -= rate * g / np.sqrt(s)
    return params


def labels_of(words, spans_of: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """1 + kind of the first base span of its text that a word overlaps, 0 for the others. The first
    span that ends behind the word's start is found by bisection: spans are in order of their
    starts, and where the largest end so far first passes the word's start, that span does."""
    out = np.zeros(len(words), np.int64)
    reach: dict[int, list[int]] = {}
    for i, (t, start, end) in enumerate(words):
        spans = spans_of[t]
        if t not in reach:
            reach[t] = list(accumulate((e for _, _, e in spans), max))
        at = bisect_right(reach[t], start)
        if at < len(spans) and spans[at][0] < end:
            out[i] = spans[at][1] + 1
    return out


def added(texts: list[str], base: list[list[tuple[int, int, int]]], params, min_marginal: float):
    """Per text the spans that the field adds to the base ones."""
    out: list[list] = [[] for _ in texts]
    words, feats, chain, groups = graph(texts, base)
    if not words:
        return out
    skip, pots, hubs = ties(groups, len(words), params[2])
    edges = np.array([*chain, *skip], np.int64).reshape(-1, 2)
    pair = np.concatenate([np.broadcast_to(params[1], (len(chain), *params[1].shape)), pots])
    node = np.concatenate([params[0][feats].sum(1), np.zeros((hubs, len(LABELS)))])
    p = marginals(node, edges, pair, part=np.array([t for t, _, _ in words], np.int64)[edges[:, 0]])
    known = labels_of(words, base)
    chained = {b for _, b in chain}
    best = p.argmax(1)
    for i, (t, start, end) in enumerate(words):
        k = int(best[i]) - 1
        if k < 0 or known[i] or p[i, best[i]] < min_marginal:
            continue
        if i in chained and out[t] and out[t][-1][1] == k and words[i - 1][2] == out[t][-1][2]:
            out[t][-1] = (out[t][-1][0], k, end)        # side by side and of one kind: one span
        else:
            out[t].append((start, k, end))
    return out


def _sample_words(batches):
    """Per sampled text: its words' features and labels and the edges."""
    for batch in batches:
        texts = [t or "" for t in batch.column(0).to_pylist()]
        base = [base_spans(t) for t in texts]
        words, feats, chain, groups = graph(texts, base)
        gold = labels_of(words, base)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
            feats, gold, np.array(chain, np.int64), np.array(paths(groups), np.int64))], ["f", "g", "c", "s"])


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"):
    """Weights from at most `sample` documents; their words' features reach the driver."""
    rows = narrow(docs, **{id_col: "string", text_col: "string"}).filter(
        F.col(text_col).rlike("[0-9@]") & (F.length(text_col) <= SAMPLE_CHARS))
    # a share of all documents that holds enough with a digit; the rows counted are those of the files
    chosen = smallest(rows, F.xxhash64(id_col, text_col), sample, docs.count() // 4, id_col, text_col).select(text_col)
    feats, gold, chain, skip, n = [], [], [], [], 0
    for r in chosen.transform(in_arrow, _sample_words, "f binary, g binary, c binary, s binary").collect():
        g = np.frombuffer(r["g"], np.int64)
        feats.append(np.frombuffer(r["f"], np.int64).reshape(len(g), PER_WORD))
        gold.append(g)
        chain.append(np.frombuffer(r["c"], np.int64).reshape(-1, 2) + n)
        skip.append(np.frombuffer(r["s"], np.int64).reshape(-1, 2) + n)
        n += len(g)
    if not n:
        return fit([], np.zeros((0, PER_WORD), np.int64), [], [], np.zeros(0, np.int64))
    return fit(range(n), np.concatenate(feats), np.concatenate(chain),
               np.concatenate(skip), np.concatenate(gold))


def _scan(params, min_marginal):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added(texts, base, params, min_marginal)
            count = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(4)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *[pa.array(c, pa.int64()) for c in count],
                pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(b + m) for b, m in zip(base, more)], pa.string()),
                pa.array([len(m) for m in more], pa.int64())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    return run


def scan(docs: DataFrame, sample: int = SAMPLE, min_marginal: float = MIN_MARGINAL, id_col: str = "doc_id",
         text_col: str = "text", params=None) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, number of added spans."""
    params = params if params is not None else train(docs, sample, id_col, text_col)
    return narrow(docs, **{id_col: "bigint", text_col: "string"}).transform(in_arrow, 
        _scan(params, min_marginal),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
        "spans string, n_added bigint")
