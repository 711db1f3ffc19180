"""Plain restatements of the operators' results, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def tokens(texts, end_id):
    from tokenizers import Tokenizer

    from marketlens.llm.tokens import default_vocabulary

    tokenizer = Tokenizer.from_file(default_vocabulary())
    return [e.ids + [end_id] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def ids_crc32(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def near_duplicates(rows, percent=85):
    """doc_id -> (set size, component)"""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts, shared = defaultdict(list), Counter()
    for d in sorted(sets):
        for s in sets[d]:
            for other in posts[s]:
                shared[other, d] += 1
            posts[s].append(d)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeated_bytes(texts, width=200):
    """Per text: bytes, removed, runs, digest of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter()
    for x in data:
        seen.update(x[i : i + width] for i in range(len(x) - width + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x) + 2, int)
        for i in range(len(x) - width + 1):
            if seen[x[i : i + width]] > 1:
                gone[i + 1] += 1
                gone[i + width + 1] -= 1
        gone = np.cumsum(gone)[1:-1] > 0
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def spelling_groups(rows):
    """word -> (form, root, n, near words, count of the form)"""
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    posts = defaultdict(set)
    for w in words:
        posts["-", w].add(w)
        for k in range(len(w)):
            posts["=", k, w[:k], w[k + 1 :]].add(w)
            posts["-", w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for key, members in posts.items():
        for a in members:
            near[a] |= {b for b in members if a != b and (key[0] == "=" or abs(len(a) - len(b)) == 1)}
    form = {}
    for w, n in words.items():
        best = min(((-words[v], v) for v in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def repair_report(rows, damage=True):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest), by a walk over whole edit strings."""
    conversations = defaultdict(list)
    for c, t, r, x in rows:
        out = conversations[c]
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 19
        r, x = " " if r is None else r, " " if x is None else x
        if d:
            x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
            out += [(t, "user" if d == 4 else r, x)] * (2 if d == 3 else 1)
    result = {}
    for c, out in conversations.items():
        out.sort(key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2]))
        turns = [t for t, _, _ in out if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, r, x in out:
            shown = x.rstrip(" \t\n\x0b\f\r")
            faults.append("blank" if not shown else "duplicate" if (r, x) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((r, x))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:], strict=False))
        new_role = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}

        def with_inserts(best):
            for _ in range(3):
                for state, (to, name) in new_role.items():
                    if to in best:
                        cost, audit, left = best[to]
                        best[state] = min(best.get(state, (10**9, "", ())), (cost + 5, "I" + audit, ((name, ""), *left)), key=lambda v: v[:2])
            return best

        best = with_inserts({"": (0, "", ()), "a": (0, "", ())})
        for (_, r, x), fault in reversed(list(zip(out, faults, strict=True))):
            ahead = {}
            for state, (to, name) in new_role.items():
                cost, audit, left = best[state]
                ways = [(cost + 2, "D" + audit, left)]
                if fault not in ("blank", "duplicate"):
                    extra = 5 if fault == "truncated" else 0
                    if (state, r[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                        cost, audit, left = best[r[:1]]
                        ways.append((cost + extra, "K" + audit, ((r, x), *left)))
                    cost, audit, left = best[to]
                    ways.append((cost + extra + 1, "R" + audit, ((name, x), *left)))
                ahead[state] = min(ways, key=lambda v: v[:2])
            best = with_inserts(ahead)
        cost, audit, left = best[""]
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
        result[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return result
