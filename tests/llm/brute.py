"""Plain versions of the operators, for small tables: what their results must equal."""

import hashlib
import re

WS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def near(docs, percent=85):
    """(doc_id, n_shingles, component_id) of each."""
    sets = {}
    for i, t in docs:
        w = WS.findall(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {}
    for ids in by.values():
        for a in range(len(ids)):
            for b in ids[:a]:
                pairs[ids[a], b] = pairs.get((ids[a], b), 0) + 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeated_bytes(docs, length=400):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = {}
    for k, (_, b) in enumerate(data):
        for p in range(len(b) - length + 1):
            seen.setdefault(hashlib.md5(b[p : p + length]).digest(), []).append((k, p))
    cover = [bytearray(len(b)) for _, b in data]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                cover[k][p : p + length] = b"\1" * length
    return [(i, len(b), sum(c), len(re.findall(b"\1+", bytes(c))), sha(bytes(x for x, y in zip(b, c) if not y))) for (i, b), c in zip(data, cover)]


def repeated_words(docs, length=35):
    data = [(i, WS.findall(t or "")) for i, t in docs]
    seen = {}
    for k, (_, w) in enumerate(data):
        for p in range(len(w) - length + 1):
            seen.setdefault(hashlib.md5(" ".join(w[p : p + length]).encode()).digest(), []).append((k, p))
    cover = [bytearray(len(w)) for _, w in data]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                cover[k][p : p + length] = b"\1" * length
    return [(i, len(w), sum(c), sha(" ".join(x for x, y in zip(w, c) if not y))) for (i, w), c in zip(data, cover)]


def license_base(docs):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        at = [(k, v) for p, v in phrases.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        out.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({v for _, v in at}))))
    return out


def contaminated(docs, items):
    windows = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    lengths = {len(x) for x in windows}
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        hit, ids = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[x]
        out.append((i, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def quality(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w, lines, at = WS.findall(t), [x for x in t.split("\n") if WS.search(x)], {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k : k + 8]), []).append(k)
        n = len({x for v in at.values() if len(v) > 1 for k in v for x in range(k, k + 8)})
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), n, len(w) < 20 or 100 * n > 30 * len(w)))
    return out


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    """Base spans (kind, start, end)."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0], flags=re.A)
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m[0], flags=re.A)) <= 15:
            out.append(("phone", m.start(), m.end()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))
