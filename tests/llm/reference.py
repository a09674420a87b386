"""Plain, single-process versions of the operators, for comparison on small tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import xxhash


def components(nodes, linked) -> dict:
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def simhash(text: str, width: int = 3) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(texts: dict, width: int = 3, radius: int = 2) -> dict:
    prints = {i: simhash(t, width) for i, t in texts.items()}
    linked = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= radius]
    groups = components(prints, linked)
    return {i: (f"{prints[i]:016x}", groups[i]) for i in prints}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def vector_links(vectors: dict, threshold: float = 0.95) -> dict:
    """id -> (n_links, component_id, kept) by comparing all pairs."""
    usable = {
        i: v for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    usable = {i: np.array(v, float) for i, v in usable.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in usable.items()}
    linked = [(a, b) for a, b in combinations(unit, 2) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    counts = Counter(x for pair in linked for x in pair)
    groups = components(vectors, linked)
    return {i: (counts[i], groups[i], groups[i] == i) for i in vectors}


#: What may be personal, in the order in which it is looked for.
CANDIDATE = "|".join(
    [
        r"(?<![0-9.])(?:[0-9]{1,3}[.]){3}[0-9]{1,3}(?![0-9]|[.][0-9])",
        r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])",
        r"(?<![0-9.])[0-9]{2}[.][0-9]{2}[.][0-9]{4}(?![0-9]|[.][0-9])",
        r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9]|/[0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
        r"(?<![0-9])(?:[+]1[ -])?(?:[(][0-9]{3}[)] ?|[0-9]{3}[ -])[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])",
        r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}[.]){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    ]
)
DAYS = [dt.date(1900, 1, 1) + dt.timedelta(i) for i in range(270 * 270)]
#: Days that slash dates with the day first can mean and month first cannot.
LATE_DAYS = [d for d in DAYS if d.day > 12][: 210 * 210]
LATE_PLACES = {d: i for i, d in enumerate(LATE_DAYS)}


class Languages:
    """Word-first language model of (text, language) pairs, every piece kept; ``log[size][piece]`` holds a value per
    language, size 0 being whole words."""

    def __init__(self, labelled):
        counts = {}
        for text, lang in labelled:
            for word in self.words(text):
                for size in range(5):
                    for piece in [word] if size == 0 else self.pieces(word, size):
                        counts.setdefault(size, {}).setdefault(lang, Counter())[piece] += 1
        self.names = sorted({lang for _, lang in labelled})
        self.log = {}
        for size, by_lang in counts.items():
            totals = {lang: sum(found.values()) for lang, found in by_lang.items()}
            least = 0.5 / max(totals.values())
            share = lambda piece, lang: by_lang[lang][piece] / totals[lang] if by_lang.get(lang, {}).get(piece) else least
            every = {piece for found in by_lang.values() for piece in found}
            self.log[size] = {p: np.log([share(p, lang) for lang in self.names]) for p in every}

    @staticmethod
    def words(text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    @staticmethod
    def pieces(word, size):
        padded = word if size == 1 else f" {word} "
        return [padded[i : i + size] for i in range(len(padded) - size + 1)]

    def judge(self, text):
        words = self.words(text)
        if not any(c.isalpha() for word in words for c in word):
            return "und", 0.0
        total = np.zeros(len(self.names))
        for word in words:
            if word in self.log[0]:
                total += self.log[0][word]
                continue
            for size in (4, 3, 2, 1):
                found = [self.log[size][p] for p in self.pieces(word, size) if p in self.log[size]]
                if found:
                    total += sum(found) / len(found)
                    break
        odds = np.exp(total - total.max())
        return self.names[int(odds.argmax())], float(odds.max() / odds.sum())


def _hash(key, tag, step, value) -> bytes:
    return hashlib.sha256(f"{key}:{tag}:{step}:{value}".encode()).digest()


def feistel(left: int, right: int, a: int, b: int, key: str, tag: str) -> tuple[int, int]:
    for step in range(8):
        if step % 2 == 0:
            left = (left + int(_hash(key, tag, step, right).hex()[:15], 16)) % a
        else:
            right = (right + int(_hash(key, tag, step, left).hex()[:15], 16)) % b
    return left, right


def feistel_digits(digits: str, key: str, tag: str) -> str:
    half, rest = len(digits) // 2, len(digits) - len(digits) // 2
    left, right = feistel(int(digits[:half]), int(digits[half:]), 10**half, 10**rest, key, tag)
    return str(left).zfill(half) + str(right).zfill(rest)


def luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total


def put_back(value: str, digits: str) -> str:
    new = iter(digits)
    return "".join(next(new) if "0" <= c <= "9" else c for c in value)


def late_date(value: str, key: str) -> tuple[str | None, str]:
    """Slash dates that only make sense with the day first."""
    try:
        place = LATE_PLACES.get(dt.datetime.strptime(value, "%d/%m/%Y").date())
    except ValueError:
        return None, value
    if place is None:
        return None, value
    left, right = feistel(place // 210, place % 210, 210, 210, key, "late date")
    return "date", LATE_DAYS[left * 210 + right].strftime("%d/%m/%Y")


def pseudonym(value: str, key: str) -> tuple[str | None, str]:
    """(kind, pseudonym); kind None for values that are not valid."""
    digits = re.sub("[^0-9]", "", value)
    if "@" in value:
        name, _, host = value.rpartition("@")
        left, right = name[: len(name) // 2], name[len(name) // 2 :]

        def shifted(half: str, step: int, other: str) -> str:
            out = []
            for c, add in zip(half, _hash(key, "email", step, other)):
                for first, n in (("0", 10), ("a", 26), ("A", 26)):
                    if 0 <= ord(c) - ord(first) < n:
                        c = chr(ord(first) + (ord(c) - ord(first) + add) % n)
                        break
                out.append(c)
            return "".join(out)

        for step in range(8):
            if step % 2 == 0:
                left = shifted(left, step, right)
            else:
                right = shifted(right, step, left)
        return "email", f"{left}{right}@{host}"
    if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", value):
        octets = value.split(".")
        if any(int(o) > 255 or str(int(o)) != o for o in octets):
            return None, value
        a, b, c, d = map(int, octets)
        left, right = feistel(a * 256 + b, c * 256 + d, 65536, 65536, key, "ip")
        return "ip", f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    for pattern, form in ((r"\d{4}-\d\d-\d\d", "%Y-%m-%d"), (r"\d\d\.\d\d\.\d{4}", "%d.%m.%Y"), (r"\d\d/\d\d/\d{4}", "%m/%d/%Y")):
        if re.fullmatch(pattern, value):
            try:
                day = (dt.datetime.strptime(value, form).date() - dt.date(1900, 1, 1)).days
            except ValueError:
                return late_date(value, key)
            if not 0 <= day < 270 * 270:
                return None, value
            left, right = feistel(day // 270, day % 270, 270, 270, key, "date")
            return "date", (dt.date(1900, 1, 1) + dt.timedelta(left * 270 + right)).strftime(form)
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", value):
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return None, value
        left, right = feistel((area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
        area = left // 99
        return "ssn", f"{area + 1 + (area >= 665):03d}-{left % 99 + 1:02d}-{right + 1:04d}"
    if re.fullmatch(r"(?:\+1[ -])?(?:\(\d{3}\) ?|\d{3}[ -])\d{3}-\d{4}", value):
        return "phone", put_back(value, digits[:-10] + feistel_digits(digits[-10:], key, "phone"))
    if luhn(digits) % 10:
        return None, value
    payload = feistel_digits(digits[:-1], key, "card")
    return "card", put_back(value, payload + str(-luhn(payload + "0") % 10))


def pseudonymised(text: str, pattern: str, key: str) -> tuple[str, list]:
    found = []

    def replace(match):
        kind, new = pseudonym(match[0], key)
        if kind:
            found.append((kind, match[0], new))
        return new

    return re.sub(pattern, replace, text, flags=re.ASCII), found
