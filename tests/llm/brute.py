"""Plain Python versions of the corpus operators, and small documents that hold every awkward case."""

from __future__ import annotations

import bisect
import hashlib
import random
import zlib
from collections import Counter

import regex

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, score int, gone int, id int, key int, h int, t int"


def awkward(seed: int = 1, docs: int = 60) -> list[tuple]:
    """Rows with copies, near copies, shared lines and passages, nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    boiler, passage = sentence(12), sentence(60)
    texts: list[str | None] = [None, "", " \t\n", "one", "two words", "!?...", "\x00 nul \x0b tab"]
    while len(texts) < docs:
        kind = rng.random()
        if kind < 0.2 and len(texts) > 12:
            words = (rng.choice([t for t in texts[7:] if t]) or "").split(" ")
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            lines = [sentence(rng.randint(3, 40)) for _ in range(rng.randint(1, 8))]
            if rng.random() < 0.4:
                lines.insert(rng.randrange(len(lines) + 1), boiler)
            if rng.random() < 0.3:
                lines.insert(rng.randrange(len(lines) + 1), boiler.replace("a", "b", 1) if rng.random() < 0.5 else boiler.upper())
            if rng.random() < 0.3:
                lines.append(sentence(5) + passage[rng.randint(0, 40) :] + sentence(4))
            texts.append("\n".join(lines))
    texts.append(sentence(20) * 400)
    rows = [(i * 3, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s1", None]), len(t or ""), 1, 2, 3, 4, 5, 6, 7) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], rows[1]]  # repeated rows


WORD = regex.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, n: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(zip(*[words[i:] for i in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


class Groups:
    def __init__(self, items) -> None:
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def near_copies(rows, n: int) -> set[tuple]:
    """(doc_id, set size, component, kept) of rows with ids."""
    sets = {r[0]: shingles(r[1], n) for r in rows}
    groups = Groups(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {(i, len(sets[i]), groups.find(i), groups.find(i) == i) for i in ids}


def removed(rows, length: int = 50) -> list[tuple]:
    """(doc_id, bytes, removed, spans, hash of the rest) for passage removal."""
    starts: dict[bytes, int] = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for i, b in texts:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            starts[w] = min(starts.get(w, i), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if starts[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def normalised(line: str) -> str:
    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip().translate(str.maketrans("123456789", "000000000"))


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` edits lead from one text to the other (only cells that near the diagonal are looked at)."""
    if abs(len(a) - len(b)) > most:
        return False
    far, row = most + 1, {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            new[j] = min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (j == 0 or x != b[j - 1]))
        row = new
    return row[len(b)] <= most


def deduped_lines(rows, share: float = 0.1) -> dict[int, tuple]:
    """doc_id -> (lines, removed, text), by plain edit similarity of all pairs of normalised lines."""
    first: dict[str, tuple] = {}
    own = {}
    for r in rows:
        for k, line in enumerate((r[1] or "").split("\n")):
            if n := normalised(line):
                own[r[0], k] = n
                first[n] = min(first.get(n, (r[0], k)), (r[0], k))
    lines = list(first)
    groups = Groups(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if groups.find(i) != groups.find(j) and within(lines[i], lines[j], int(share * max(len(lines[i]), len(lines[j])))):
                groups.join(i, j)
    keep: dict[int, tuple] = {}
    for i, n in enumerate(lines):
        g = groups.find(i)
        keep[g] = min(keep.get(g, first[n]), first[n])
    group_of = {n: groups.find(i) for i, n in enumerate(lines)}
    out = {}
    for r in rows:
        text = (r[1] or "").split("\n")
        kept = [x for k, x in enumerate(text) if (r[0], k) not in own or keep[group_of[own[r[0], k]]] == (r[0], k)]
        out[r[0]] = (0 if r[1] is None else len(text), len(text) - len(kept), None if r[1] is None else "\n".join(kept))
    return out


def tokens(text: str | None, model) -> list[int]:
    return model.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def mixed(rows, weights=(5, 2, 1), share=1.5, cap=2.0) -> list[tuple]:
    """(doc_id, size, source_size, target, taken) of weighted fair mixing."""
    docs = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows]
    size = Counter()
    for _, s, n in docs:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, budget, target = set(order), sum(size.values()) * share, {}
    while left:
        level = (budget - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if cap * size[s] < level * weight[s]}
        for s in over or left:
            target[s] = cap * size[s] if over else level * weight[s]
        left -= over or left
    shuffled = sorted(((hashlib.md5(f"mix{'' if i is None else i}".encode()).hexdigest(), i, n, s) for i, s, n in docs), key=lambda x: (x[0], x[1] or 0, x[2]))
    done, queue = Counter(), []
    for number, (h, i, n, s) in enumerate(shuffled):
        done[s] += n
        for k in range(2):
            if n and target[s]:
                queue.append(((done[s] + k * size[s]) / target[s], s is None, s or "", h, i or 0, n, k, number))
    used, taken = 0, Counter()
    for *_, n, _, number in sorted(queue):
        taken[number] += max(0, min(n, int(budget) - used))
        used += n
    return sorted(((i, n, size[s], round(target[s], 6), taken[k]) for k, (_, i, n, s) in enumerate(shuffled)), key=str)


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    """Number of sequences of plain best-fit decreasing."""
    gaps: list[int] = []
    n = 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at == len(gaps):
            n += 1
            bisect.insort(gaps, capacity - length)
        else:
            bisect.insort(gaps, gaps.pop(at) - length)
    return n
