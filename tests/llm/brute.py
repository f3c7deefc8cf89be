"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def ngrams(text, k):
    w = BLANK_WORDS.findall(lower(text))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(rows, k, percent):
    """``[(size, component)]`` for ``[(doc_id, text)]``; equal ids are not the same node."""
    sets = [ngrams(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)].append(key)
    return [(len(s), min(least[root(i)], default=None) if s else rows[i][0]) for i, s in enumerate(sets)]


def contamination(rows, items):
    windows = defaultdict(set)
    for key, text in items:
        w = ITEM_WORDS.findall(lower(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(key)
    out = []
    for _, text in rows:
        w, hit, found = ITEM_WORDS.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (gram := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[gram]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def statistics(text):
    text = text or ""
    w = BLANK_WORDS.findall(text)
    seen3, seen_lines, lines, covered = Counter(zip(w, w[1:], w[2:])), set(), 0, set()
    for i in range(len(w) - 2):
        if seen3[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if BLANK_WORDS.search(line):
            lines += line in seen_lines
            seen_lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


class KneserNey:
    """Interpolated modified Kneser-Ney bigrams over token lists."""

    def __init__(self, texts):
        self.count = Counter(x for t in texts for x in t)
        self.pairs = Counter(p for t in texts for p in zip(["<s>", *t], t))
        self.before = Counter(v for _, v in self.pairs)
        self.high, self.low = self.discounts(self.pairs), self.discounts(self.before)
        kinds = Counter(min(n, 3) for n in self.before.values())
        self.rest = sum(self.low[k - 1] * kinds[k] for k in (1, 2, 3)) / max(1, len(self.pairs))
        self.after = defaultdict(lambda: [0, 0, 0, 0])
        for (u, _), n in self.pairs.items():
            self.after[u][0] += n
            self.after[u][min(n, 3)] += 1

    @staticmethod
    def discounts(counts):
        n = [sum(1 for c in counts.values() if c == k) for k in (1, 2, 3, 4)]
        if min(n) == 0:
            return (0.5, 1.0, 1.5)
        y = n[0] / (n[0] + 2 * n[1])
        return tuple(min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0), k + 1) for k in range(3))

    def unigram(self, v):
        if not self.pairs:
            return 1.0
        n = self.before[v]
        return max(n - (0, *self.low)[min(n, 3)], 0) / len(self.pairs) + self.rest / (len(self.count) + 1)

    def p(self, v, u):
        if u not in self.after:
            return self.unigram(v)
        total, *kinds = self.after[u]
        n = self.pairs[(u, v)]
        rest = sum(d * k for d, k in zip(self.high, kinds)) / total
        return max(n - (0, *self.high)[min(n, 3)], 0) / total + rest * self.unigram(v)


def language_scores(rows):
    def tokens(text):
        return [*BLANK_WORDS.findall(lower(text)), None]

    def held(key):
        return zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0

    model = KneserNey([tokens(t) for k, t in rows if not held(k)])
    total, size = sum(model.count.values()), len(model.count)
    out = []
    for key, text in rows:
        t = tokens(text)
        base = sum(math.log10((model.count[v] + 0.1) / (total + 0.1 * (size + 1))) for v in t)
        score = sum(math.log10(model.p(v, u)) for u, v in zip(["<s>", *t], t))
        out.append((held(key), len(t), sum(model.count[v] > 0 for v in t), total, base, score))
    return model, out


def damaged(rows):
    """Rows of ``conv_id, turn, role, text`` after the stated damage; a conversation stays as a key without rows."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def repair(rows):
    """``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of turns in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [(role or " ")[0] for _, role, _ in rows]
    follows, names = {"0": "u", "s": "u", "a": "u", "u": "a"}, {"u": "user", "a": "assistant"}
    closing = {"0": (0, "", ()), "a": (0, "", ()), "u": (3, "I", ("assistant:",)), "s": (6, "II", ("user:", "assistant:"))}
    after = dict(closing)
    for (_, role, text), initial, fault in zip(rows[::-1], initials[::-1], faults[::-1]):
        late = 3 * (fault == "truncated")

        def join(cost, letter, line, rest):
            return cost + rest[0], letter + rest[1], (*([line] if line is not None else []), *rest[2])

        now = {}
        for state in "0sua":
            options = [join(4, "D", None, after[state])]
            if fault not in ("blank", "duplicate"):
                want = follows[state]
                options.append(join(3 + late, "R", f"{names[want]}:{text}", after[want]))
                if initial == want or (state == "0" and initial == "s"):
                    options.append(join(late, "K", f"{role}:{text}", after[initial]))
            now[state] = min(options)
        for _ in range(2):
            for state in "0sua":
                want = follows[state]
                now[state] = min(now[state], join(3, "I", f"{names[want]}:", now[want]))
        after = now
    cost, audit, lines = after["0"] if rows else (0, "", ())
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(key, text):
    """``n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``."""
    text = text or ""
    units, h = UNITS.findall(text), hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n, form, output, sizes = len(units), "plain", text, (None, None)
    if text and not any(m in text for m in ("<P>", "<S>", "<M>")) and h3 % 100 < 50:
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form, sizes = "spm" if h4 % 100 < 80 else "psm", (len(p), len(m))
        output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, *sizes, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
