"""Plain versions of the operators for small inputs: no index, no anchors, no sketches."""

import hashlib
import re
import zlib
from collections import defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeated_bytes(rows, size):
    seen = defaultdict(list)
    for r, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for i in range(len(b) - size + 1):
            seen[b[i : i + size]].append((r, i))
    gone = defaultdict(list)
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                gone[r].append(i)
    out = []
    for r, (d, t) in enumerate(rows):
        b = (t or "").encode()
        off = bytearray(len(b))
        for i in gone[r]:
            off[i : i + size] = b"\1" * size
        out.append((d, len(b), sum(off), len(re.findall(rb"\x01+", bytes(off))), sha(bytes(x for x, o in zip(b, off) if not o))))
    return out


def lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    cut = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda x: x.strip(BLANKS).translate(LOW)
    rank = lambda d: -(2**63) if d is None else d
    for d, parts in cut:
        for x in parts:
            if len(key(x)) >= min_chars:
                holders[key(x)].add(rank(d))
    out = []
    for d, parts in cut:
        kept = [x for x in parts if not (len(holders.get(key(x), ())) >= min_docs and rank(d) != max(holders[key(x)]))]
        out.append((d, len(parts), len(parts) - len(kept), sha("\n".join(kept))))
    return out


def near(rows, percent, k):
    sets = []
    for d, t in rows:
        w = words((t or "").translate(LOW))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return [(d, len(s), low.get(top(i)) if d is not None else None, d is None or d == low[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def repeated_words(rows, size):
    rank = lambda d: -(2**63) if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(rank(d), first.get(k, rank(d)))
    out = []
    for d, t in rows:
        w = words(t)
        off = [0] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < rank(d):
                off[i : i + size] = [1] * size
        out.append((d, len(w), sum(off), sha(" ".join(x for x, o in zip(w, off) if not o))))
    return out


def nearest(rows, k, every):
    def usable(v):
        return v is not None and all(x is not None and abs(x) < float("inf") for x in v) and any(v)

    good = [(i, v) for i, v in rows if i is not None and usable(v)]
    good = [(i, v) for i, v in good if len(v) == max(len(u) for _, u in good)]
    out = []
    for q, v in good:
        if q % every == 0:
            near = sorted((sum((a - b) ** 2 for a, b in zip(u, v)) ** 0.5, i) for i, u in good if i != q)[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return out


def spelling(rows, every=97, least=5, min_count=3, ratio=2):
    counts = defaultdict(int)
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % every == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= min_count and len(w) >= least}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None))
    return out


def warc(rows, least=100):
    """(page_id, url, payload_bytes, digest, kind, refers_to) by the payloads alone."""
    rank = lambda p: (p is None, p)
    lowest = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= least and (b not in lowest or rank(p) < rank(lowest[b])):
            lowest[b] = p
    out = []
    for p, u, h in rows:
        b = (h or "").encode()
        other = len(b) >= least and lowest[b] != p
        out.append((p, u, len(b), sha(b), "revisit" if other else "response", lowest[b] if other else None))
    return out


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if code == 0:
            out.append((c, t, None, None))
            continue
        x = "" if code == 1 else re.sub("[.!?]", "", x) if code == 2 else x
        out += [(c, t, "user" if code == 4 else r, x)] * (2 if code == 3 else 1)
    return out


def repaired(rows, tie):
    """All cheapest audits by exhaustive search over states; ``tie`` orders rows of one turn."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c] += [(t, r, x)] if r is not None else []
    out = []
    for c, held in convs.items():
        held.sort(key=lambda y: (y[0] is not None, y[0] or 0, tie(y)))
        seen, faults = set(), []
        for _, r, x in held:
            bare = x.strip(BLANKS)
            faults.append("b" if not bare else "d" if (r, x) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((r, x))
        step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
        best = {"": (0, {("", ())})}  # state: cost, (audit, lines)

        def offer(into, state, cost, ways):
            if state not in into or cost < into[state][0]:
                into[state] = (cost, set(ways))
            elif cost == into[state][0]:
                into[state][1].update(ways)
            # what is larger and does not go on from the smallest can never become the first
            first = min(w for w, _ in into[state][1])
            into[state] = (into[state][0], {x for x in into[state][1] if x[0].startswith(first)})

        def open_turns(at):
            for _ in range(4):
                for q, (cost, ways) in list(at.items()):
                    for i, name in (("u", "user"), ("a", "assistant")):
                        if i in step[q]:
                            offer(at, step[q][i], cost + 2, [(w + "I", k + (name + ":",)) for w, k in ways])
            return at

        for (_, r, x), f in zip(held, faults):
            then = {}
            for q, (cost, ways) in open_turns(best).items():
                offer(then, q, cost + 3, [(w + "D", k) for w, k in ways])
                if f in ("b", "d"):
                    continue
                extra = f == "t"
                if r[:1] in step[q]:
                    offer(then, step[q][r[:1]], cost + extra, [(w + "K", k + (f"{r}:{x}",)) for w, k in ways])
                for i, name in (("u", "user"), ("a", "assistant")):
                    if i in step[q]:
                        offer(then, step[q][i], cost + 2 + extra, [(w + "R", k + (f"{name}:{x}",)) for w, k in ways])
            best = then
        best = open_turns(best)
        cost = min(best[q][0] for q in ("", "a") if q in best)
        audit, lines_ = min(w for q in ("", "a") if q in best and best[q][0] == cost for w in best[q][1])
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        out.append((c, gaps, *(faults.count(k) for k in "bdt"), pairs, cost, audit, sha("\n".join(lines_))))
    return out
