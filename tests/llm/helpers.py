"""Small documents with every odd case, and plain versions of what the operators compute."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = "ka to mi re su lo ne pa vi do gu he ji la zo".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)) + "."


def text(rng, lines=4, words=14):
    return "\n".join(sentence(rng, words) for _ in range(lines))


def documents():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, nulls, empty and long texts, ties."""
    rng = random.Random(5)
    base = [text(rng) for _ in range(12)]
    passage = sentence(rng, 90)
    texts = list(base)
    texts += [base[0]] * 4 + [base[1]] * 2
    for i in range(8):  # near copies of one text, at several distances
        words = base[2].split(" ")
        for k in rng.sample(range(len(words)), i):
            words[k] = "xyz" + str(k)
        texts.append(" ".join(words))
    texts += [sentence(rng, 20) + "\n" + passage + "\n" + sentence(rng, 20) for _ in range(3)]
    texts += [None, "", " \t\n", "one two", "one two", "ONE  Two", "\n\n\n", "ab " * 400, text(rng, 400, 30)]
    texts += ["été çà " + base[3], "été çà " + base[3].upper(), "日本語 " * 30 + "𝔘𝔫𝔦 ␀ it's don't 12.5%"]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 9 == 4 else ("hot" if i % 3 else f"s{i % 4}")
        rows.append((i, t, None if i % 7 == 3 else "en", source, None if t is None else len(t)))
    rows.append((None, base[5], "en", "hot", 3))
    rows += [rows[6], rows[6]]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def shingles(t):
    words = WORD.findall(lower(t or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near_groups(sets, percent):
    """Components of row numbers whose sets are similar."""
    groups = Groups(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return [groups.root(i) for i in range(len(sets))]


def cut_lines(rows, size=10, least=20, percent=75):
    """Texts without nearly repeated lines."""
    places = defaultdict(list)
    for r, row in enumerate(rows):
        for k, line in enumerate((row[1] or "").split("\n")):
            plain = lower(re.sub(r"[\x20\x09-\x0D]", "", line))
            if len(plain) >= least:
                places[plain].append((row[0] is None, row[0] or 0, k, r))
    lines = list(places)
    sets = [{x[j : j + size] for j in range(len(x) - size + 1)} for x in lines]
    groups = near_groups(sets, percent)
    whole = defaultdict(list)
    for i, line in enumerate(lines):
        whole[groups[i]] += places[line]
    gone = defaultdict(int)
    for members in whole.values():
        for none, doc, k, r in sorted(members)[1:]:
            gone[r] += 1
    return [gone[r] for r in range(len(rows))]


def covered(texts, size):
    """Per text the flags of bytes in strings of ``size`` bytes that start elsewhere too."""
    data = [(t or "").encode() for t in texts]
    found = Counter(d[k : k + size] for d in data for k in range(len(d) - size + 1))
    out = []
    for d in data:
        flags = [False] * len(d)
        for k in range(len(d) - size + 1):
            if found[d[k : k + size]] > 1:
                flags[k : k + size] = [True] * size
        out.append(flags)
    return out
