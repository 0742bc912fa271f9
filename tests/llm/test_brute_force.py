"""Queries without SQL against plain versions of them, over the whole smallest documents."""

import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from pubweave.llm import quality, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_fingerprint(text):
    words = WORD.findall(ascii_lower(text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = Counter(b for h in hashes for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(hashes))


def test_near_duplicates(spark, rows):
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = {i: i for i in fps}
    changed = True
    while changed:  # the smallest id spreads along the links
        changed = False
        for i in fps:
            for j in fps:
                if root[j] < root[i] and (fps[i] ^ fps[j]).bit_count() <= 3:
                    root[i], changed = root[j], True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in fps}
    assert len(set(root.values())) < len(root)


def plain_class(c):
    """Position in the fixed list of classes."""
    if ord(c) >= 128:
        return quality.CLASSES.index("other letter" if c.isalpha() else "other")
    if c.isalpha():
        return quality.CLASSES.index("lower" if c.islower() else "upper")
    kinds = {"digit": "0123456789", "space": " \t\n\v\f\r", "punctuation": quality.PUNCTUATION, "symbol": quality.SYMBOLS}
    return quality.CLASSES.index(next((k for k, chars in kinds.items() if c in chars), "other ASCII"))


def plain_distance(a, b):
    """Of two histograms as dicts."""
    n, m = sum(a.values()), sum(b.values())
    entropy = lambda p: -sum(x * math.log2(x) for x in p if x)
    p, q = {k: v / n for k, v in a.items()}, {k: v / m for k, v in b.items()}
    keys = set(p) | set(q)
    middle = entropy([(p.get(k, 0) + q.get(k, 0)) / 2 for k in keys])
    return math.sqrt(max(0, middle - (entropy(p.values()) + entropy(q.values())) / 2))


def test_divergence(spark, rows):
    limits = quality.Params()
    words, classes = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        words[r.lang or "und"].update(WORD.findall(ascii_lower(r.text or "")))
        classes[r.lang or "und"].update(map(plain_class, r.text or ""))
    common = {k: set(sorted(c, key=lambda w: (-c[w], w.encode()))[: limits.common]) for k, c in words.items()}
    binned = lambda k, c: Counter({w: n for w, n in c.items() if w in common[k]}) + Counter({None: sum(n for w, n in c.items() if w not in common[k])})
    got = {r.doc_id: r for r in queries.op2_divergence(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        text, lang, own = r.text or "", r.lang or "und", got[r.doc_id]
        found = WORD.findall(text)
        grams = Counter(zip(found, found[1:], found[2:], strict=False))
        repeated = {i + k for i, g in enumerate(zip(found, found[1:], found[2:], strict=False)) if grams[g] > 1 for k in range(3)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        failed = len(found) < 50 or 100 * len(repeated) > 50 * len(found)
        assert (own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, own.n_repeat_words, own.base_failed) == (
            len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(repeated), failed,
        )
        a = plain_distance(Counter(map(plain_class, text)), classes[lang]) if len(text) >= limits.min_chars else None
        b = plain_distance(binned(lang, Counter(WORD.findall(ascii_lower(text)))), binned(lang, words[lang])) if len(found) >= limits.min_words else None
        for ours, plain in ((own.class_distance, a), (own.word_distance, b)):
            assert (ours is None) == (plain is None) and (plain is None or ours == pytest.approx(plain, abs=1e-6))
        assert own.kept == (not failed and (a is None or a <= limits.max_class_distance) and (b is None or b <= limits.max_word_distance))
