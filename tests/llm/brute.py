"""The contracts of the operators in plain Python, text by text."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    text = text or ""

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(int(part) <= 255 for part in m[0].split(".")),
        ),
        "card": (
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        ),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    found = {
        kind: [m.span() for m in re.finditer(pattern, text) if fits(m)]
        for kind, (pattern, fits) in rules.items()
    }
    spans = ",".join(f"{kind}:{a}:{b}" for kind in found for a, b in found[kind])
    return (*[len(found[kind]) for kind in found], sha(spans))


def secrets(text):
    text = text or ""
    rules = [
        (
            "assign",
            r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            lambda m: len(m[2]) >= 8,
        ),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern, fits) in enumerate(rules)
        for m in re.finditer(pattern, text)
        if fits(m)
    ]
    counts = Counter(kind for *_, kind in found)
    spans = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    return (*[counts[kind] for kind, *_ in rules], sha(spans))


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(ch in "#*$%&|<>" for ch in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def shingles(text, width):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(texts, width, percent=80):
    """doc_id -> (set size, smallest reachable doc_id)."""
    sets = {doc: shingles(text, width) for doc, text in texts.items()}
    parent = {doc: doc for doc in texts}

    def top(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    docs = sorted(texts)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            one, two = sets[a], sets[b]
            if not one or not two or 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
                continue
            shared = len(one & two)
            if 100 * shared >= percent * (len(one) + len(two) - shared):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), top(doc)) for doc in docs}


def repeats(docs, length=50):
    """(n_bytes, n_removed, n_spans, digest) of each of the (doc_id, text)."""
    first = {}
    for doc, text in sorted(d for d in docs if d[0] is not None):
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], doc)
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if doc is not None and first[raw[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def with_repeated_tail(doc, words):
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def runs(words, least=24):
    """(start, length, period), every period tried."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            k = i
            while k < n - q and words[k] == words[k + q]:
                k += 1
            if k - i + q >= max(least, 3 * q):
                found.setdefault((i, k - i + q), q)
            i = max(k, i + 1)
    return sorted((i, length, q) for (i, length), q in found.items())


def run_report(doc, text):
    words = with_repeated_tail(doc, WORD.findall(text or ""))
    every = runs(words)
    gone = {k for s, length, q in every for k in range(s + q, s + length)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    best = (None,) * 4
    for s, length, q in every:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    written = "".join(f"{s},{length},{q}\n" for s, length, q in every)
    return (doc, len(every), *best, sha(written), sha(kept))


def conversations(rows):
    """conv_id -> (role, text) of the turns in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append(((turn is not None, turn), role or "", text or ""))
    return {conv: [turn[1:] for turn in sorted(turns)] for conv, turns in out.items()}


def trie(rows):
    convs = conversations(r for r in rows if r[0] is not None)
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    nodes, children = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    leaves, saved, out = {}, {}, []
    for path in sorted(nodes, key=len, reverse=True):
        if path:
            children[path[:-1]].append(path)
        own = (len(nodes[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = sum(saved[k] for k in children[path]) + own
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append(
            (min(members), len(path), parent, len(members), len(children[path]), leaves[path], saved[path], sha(ends))
        )
    return sorted(out, key=repr)


def chats(rows):
    out = []
    for c, turns in conversations(rows).items():
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        out.append((c, len(turns), sha(whole), len(loss), sha(loss)))
    return sorted(out, key=repr)


# The unit words of the contract of decontamination.
UNITS = set(
    "% ° km m cm mm mi miles mile ft feet inches inch kg g mg lb lbs pounds oz l ml liters litres s sec seconds "
    "second min minutes minute h hours hour days day weeks week months month years year kmh mph dollars dollar "
    "cents euros euro usd eur percent degrees watts volts".split()
)


def slots(text):
    """(raw, template, names) tokens of a text, token by token."""
    words, before = [], "."
    for word in WORD.findall("".join(ch for ch in text or "" if ch.isalnum() or ch in "%$€£°.!? \t\n\x0b\x0c\r")):
        raw = word.lower().rstrip(".!?")
        if not word.rstrip(".!?"):
            continue
        number = re.match("[$€£]?[0-9]", word)
        if number:
            both = ("<n>", "<n>")
        elif re.match("[$€£]?[0-9]", before) and raw in UNITS:
            both = ("<u>", "<u>")
        elif word[0].isupper() and word[1:2].islower():
            both = (raw, "<p>") if before[-1] in ".!?" else ("<p>", "<p>")
        else:
            both = (raw, raw)
        words.append((raw, *both))
        before = word
    return [list(x) for x in zip(*words)] or [[], [], []]


def leaks(doc, item, window=8, least=6, most_slots=4, share=0.8):
    """Whether an item (raw, template, names) is found in a document, every distance and template tried."""
    n = len(item[0]) - window + 1
    marks = ("<n>", "<u>", "<p>")
    for which in (1, 2):
        first = [a != b for a, b in zip(item[1], item[2])]
        if which == 2 and not any(first):
            continue

        def firm_at(k):
            raw = item[0][k]
            stands = any(r == raw and t == "<p>" for r, t in zip(item[0], item[1]))
            several = sum(f and r == raw for f, r in zip(first, item[0])) > 1
            return which == 2 and first[k] and len(item[0]) < window + least - 1 and not stands and not several

        template = item[which]
        firm = [firm_at(k) for k in range(len(template))]

        def places(i):
            return [k for k in range(window) if template[i + k] in marks]

        words = sum(len(places(i)) < window for i in range(n))
        is_plain = [sum(not firm[i + k] for k in places(i)) <= most_slots for i in range(n)]
        for shift in range(-(n - 1), len(doc[0]) - window + 1):
            found = equal = plain = 0
            pairs = set()
            for i in range(max(0, -shift), min(n, len(doc[0]) - window + 1 - shift)):
                at, ks = i + shift, places(i)
                if doc[which][at : at + window] != template[i : i + window]:
                    continue
                mine, theirs = ([side[0][x + k] for k in ks] for side, x in ((item, i), (doc, at)))
                if len(ks) == window and mine != theirs:
                    continue
                if any(firm[i + k] and a != b for k, a, b in zip(ks, mine, theirs)):
                    continue
                found += 1
                equal += mine == theirs
                plain += is_plain[i]
                pairs |= {(a, b) for k, a, b in zip(ks, mine, theirs) if not firm[i + k]}
            if not found:
                continue
            consistent = len({a for a, _ in pairs}) >= share * len(pairs)
            n_plain = sum(is_plain)
            alike = n_plain > 0 and plain >= min(least, n_plain) and found >= min(least, words) and consistent
            if alike or equal >= min(least, n):
                return True
    return False


def grams(text, longest=3):
    """Distinct n-grams of a text's letters, with one blank for what lies between and around them."""
    lower = (text or "").lower()
    if not any(ch.isalpha() for ch in lower):
        return frozenset()
    flat = " " + re.sub(" +", " ", "".join(ch if ch.isalpha() else " " for ch in lower)) + " "
    return frozenset(flat[i : i + n] for n in range(1, longest + 1) for i in range(len(flat) - n + 1))
