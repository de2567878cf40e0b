"""Plain Python versions of the operators' results, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def substring_dedup(rows, size=50):
    first = {}
    for doc, text in rows:
        w = SPACED.findall(text or "")
        for i in range(len(w) - size + 1) if doc is not None else ():
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w = SPACED.findall(text or "")
        gone = set()
        for i in range(len(w) - size + 1) if doc is not None else ():
            if first[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def decontaminate(rows, items, n=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows[tuple(w[i : i + k])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if ids := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def hit_words(rows, items, n=10):
    """The positions of the words inside benchmark windows, per document."""
    windows = {tuple(w[i : i + min(n, len(w))]) for _, t in items if (w := ALNUM.findall(lower(t))) for i in range(len(w) - min(n, len(w)) + 1)}
    sizes, out = {len(k) for k in windows}, []
    for _, text in rows:
        w = ALNUM.findall(lower(text))
        out.append({p for k in sizes for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in windows for p in range(i, i + k)})
    return out


def simhash(rows, shingle=3, radius=3):
    import xxhash

    prints = []
    for doc, text in rows:
        w = SPACED.findall(lower(text))
        if not w:
            prints.append((doc, 0))
            continue
        parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints.append((doc, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[i + 1 :]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    low = {}
    for doc, p in prints:
        r = find(p)
        if doc is not None:
            low[r] = min(low.get(r, doc), doc)
    return [(doc, f"{p:016x}", low.get(find(p))) for doc, p in prints]


def simhash_kept(rows):
    """One (id, text) of each component: the smallest id, then the smallest digest; all rows without an id."""
    group = [c for _, _, c in simhash(list(enumerate(t for _, t in rows)))]
    first = {}
    for (doc, text), c in zip(rows, group):
        if doc is not None:
            first.setdefault(c, []).append((doc, sha(text or ""), text))
    return [(d, t) for d, _, t in (min(x, key=lambda r: r[:2]) for x in first.values())] + [r for r in rows if r[0] is None]


def quality_counts(text):
    w = SPACED.findall(text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            covered.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


def quality_features(text):
    t = text or ""
    n, chars, symbols, dup, repeats, _ = quality_counts(t)
    words, letters = max(n, 1), max(chars, 1)
    count = lambda p: len(re.findall(p, t))
    lines = sum(bool(SPACED.search(x)) for x in t.split("\n"))
    return {
        "n_words": float(n),
        "mean_word": chars / words,
        "symbols": symbols / letters,
        "marks": count("[!?]") / letters,
        "capitals": count("[A-Z]") / letters,
        "digits": count("[0-9]") / letters,
        "dup_lines": dup / max(lines, 1),
        "repeats": repeats / words,
        "distinct_words": len(set(SPACED.findall(t))) / words,
    }


def quality_list(rows, bins, min_bad=5, min_precision=0.9):
    """Sequential covering over (features, label, held part) rows, without bins or counts."""
    names = list(rows[0][0])
    cuts = {}
    for f in names:
        cuts[f] = set()
        for y in {r[1] for r in rows}:
            v = sorted(r[0][f] for r in rows if r[1] == y)
            cuts[f] |= {v[max(math.ceil(k / bins * len(v)) - 1, 0)] for k in range(bins + 1)}
        cuts[f] = sorted(cuts[f])

    def meets(x, rule):
        return all((x[f] >= t) == up for f, up, t in rule)

    def count(some):
        bad = sum(r[1] == 0 for r in some)
        return bad, len(some) - bad

    def precision(some):
        bad, good = count(some)
        return (bad + 1) / (bad + good + 2)

    out = []
    while True:
        rule, inside = [], [r for r in rows if not r[2]]
        while True:
            bad, good = count(inside)
            if not good or bad < min_bad:
                break
            before, best = math.log2(bad / (bad + good)), (0.0, None)
            for f in names:
                for t in cuts[f]:
                    below = [r for r in inside if r[0][f] < t]
                    for up, (x, y) in ((False, count(below)), (True, tuple(a - b for a, b in zip((bad, good), count(below))))):
                        if x >= min_bad and x * (math.log2(x / (x + y)) - before) > best[0] + 1e-9:
                            best = (x * (math.log2(x / (x + y)) - before), (f, up, t))
            if best[1] is None:
                break
            rule.append(best[1])
            inside = [r for r in inside if meets(r[0], rule[-1:])]
        if not rule:
            return out
        held_part = [r for r in rows if r[2]]
        covered = lambda k: [r for r in held_part if meets(r[0], k)]
        while len(rule) > 1 and precision(covered(rule[:-1])) >= precision(covered(rule)):
            rule = rule[:-1]
        if precision(covered(rule)) < min_precision or count(covered(rule))[0] < min_bad:
            return out
        out.append(rule)
        rows = [r for r in rows if not meets(r[0], rule)]


def pii(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19:
            t = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d))))
            if t % 10 == 0:
                out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def held(doc, folds):
    return doc is None or zlib.crc32(str(doc).encode()) % folds == 0


def kneser_ney(rows):
    """Base and modified Kneser-Ney bigram scores, straight from the formulas."""
    toks = [(doc, [*SPACED.findall(lower(text)), None]) for doc, text in rows]
    train = [t for doc, t in toks if not held(doc, 10)]
    c = Counter(x for t in train for x in t)
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for t in train for p in zip(["<s>", *((x, 0) for x in t[:-1])], t))
    ctx, follow = defaultdict(list), Counter()
    for (a, b), k in pairs.items():
        ctx[a].append(k)
        follow[b] += 1

    def discounts(counts):
        m = Counter(counts)
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + 2 * m[2] else 0
        d = [k - (k + 1) * y * m[k + 1] / m[k] if m[k] else 0 for k in (1, 2, 3)]
        return [0] + [x if 0 < x < k else 0.5 for k, x in zip((1, 2, 3), d)]

    d2, d1 = discounts(pairs.values()), discounts(follow.values())
    types = sum(follow.values())
    gamma1 = sum(d1[min(k, 3)] for k in follow.values()) / types if types else 1

    def p1(w):
        if not types:
            return 1 / (v + 1)
        return max(follow[w] - d1[min(follow[w], 3)], 0) / types + gamma1 / (v + 1)

    def p2(a, w):
        if a not in ctx:
            return p1(w)
        k, total = pairs[(a, w)], sum(ctx[a])
        return max(k - d2[min(k, 3)], 0) / total + sum(d2[min(x, 3)] for x in ctx[a]) / total * p1(w)

    out = []
    for doc, t in toks:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        score = sum(math.log10(p2(a, w)) for a, w in zip(["<s>", *((x, 0) for x in t[:-1])], t))
        out.append((doc, held(doc, 10), len(t), sum(c[x] > 0 for x in t), n, base, score))
    return out


def kneser_ney_3(rows):
    """Modified Kneser-Ney trigram scores, straight from the formulas."""
    toks = [(doc, [*SPACED.findall(lower(text)), None]) for doc, text in rows]
    train = [t for doc, t in toks if not held(doc, 10)]
    v = len({x for t in train for x in t})
    marks = lambda t, k: [*["<s>"] * k, *((x, 0) for x in t[:-1])][: len(t)]
    triples = Counter(x for t in train for x in list(zip(marks(t, 2), marks(t, 1), t))[1:])
    pairs = Counter((b, w) for _, b, w in triples) + Counter(("<s>", t[0]) for t in train)
    levels = [{(a, b): {} for a, b, _ in triples}, {b: {} for b, _ in pairs}, {(): Counter(w for _, w in pairs)}]
    for (a, b, w), k in triples.items():
        levels[0][a, b][w] = k
    for (b, w), k in pairs.items():
        levels[1][b][w] = k
    discounts = []
    for level in levels:
        m = Counter(k for c in level.values() for k in c.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + 2 * m[2] else 0
        d = [k - (k + 1) * y * m[k + 1] / m[k] if m[k] else 0 for k in (1, 2, 3)]
        discounts.append([0] + [x if 0 < x < k else 0.5 for k, x in zip((1, 2, 3), d)])

    sums = [{c: (sum(n.values()), sum(d[min(x, 3)] for x in n.values())) for c, n in level.items()} for level, d in zip(levels, discounts)]

    def p(depth, a, b, w):
        if depth == 3:
            return 1 / (v + 1)
        context, d = ((a, b), b, ())[depth], discounts[depth]
        low = p(depth + 1, a, b, w)
        if not levels[depth].get(context):
            return low
        k, (total, gamma) = levels[depth][context].get(w, 0), sums[depth][context]
        return max(k - d[min(k, 3)], 0) / total + gamma / total * low

    return [(doc, sum(math.log10(p(0, a, b, w)) for a, b, w in zip(marks(t, 2), marks(t, 1), t))) for doc, t in toks]


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def url(u):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    host, best = lower(raw), (None, None)
    for verdict, rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def url_verdicts(urls, rules, many=24, smoothing=8.0, cut=0.5):
    """(template, verdict) by trees in plain dictionaries."""
    def form(s):
        tail = (re.search(r"[.][A-Za-z]{2,5}$", s) or [""])[0]
        stem = s[: len(s) - len(tail)]
        if re.search("^[0-9]+$", stem):
            return "{n}" + tail
        if re.search("^[0-9a-fA-F-]{8,}$", stem):
            return "{hex}" + tail
        return "{id}" + tail if re.search("[0-9]", stem) and len(stem) >= 6 else s

    def parts(u):
        host, path, *_ = url(u)
        best = (None, None)
        for verdict, rule in rules:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
                best = (rule, verdict)
        return host, tuple(form(s) for s in path.split("/") if s), *best

    rows = [parts(u) for u in urls]
    template = {(h, p): list(p) for h, p, *_ in rows}
    for d in range(max(len(p) for _, p in template)):
        children = defaultdict(set)
        for (h, p), t in template.items():
            if len(p) > d:
                children[h, tuple(t[:d])].add(p[d])
        for (h, p), t in template.items():
            if len(p) > d and len(children[h, tuple(t[:d])]) > many:
                t[d] = "*"
    stats = defaultdict(lambda: [0, 0])  # examples, blocked
    for h, p, rule, verdict in rows:
        x = stats[h, tuple(template[h, p])]
        x[0] += rule is not None
        x[1] += verdict == "block"
    merged = {k: k[1] for k in stats}
    for d in reversed(range(max(len(t) for _, t in stats))):
        branch, pooled = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for (h, t), x in stats.items():
            m = merged[h, t]
            if len(m) > d and x[0] and m[d] != "*" and not re.match(r"\{(n|hex|id)\}", m[d]):
                for k in (0, 1):
                    branch[h, m][k] += x[k]
        for (h, m), x in branch.items():
            for k in (0, 1):
                pooled[h, (*m[:d], "*", *m[d + 1 :])][k] += x[k]
        joins = {}
        for (h, m), (n, b) in branch.items():
            g = (*m[:d], "*", *m[d + 1 :])
            all_n, all_b = pooled[h, g]
            if all_n > n:
                share = all_b / all_n
                gap = b / n - (all_b - b) / (all_n - n)
                if abs(gap) <= 1.96 * math.sqrt(share * (1 - share) * (1 / n + 1 / (all_n - n))):
                    joins[h, m] = g
        for k in merged:
            merged[k] = joins.get((k[0], merged[k]), merged[k])
    by_host, general = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (h, t), x in stats.items():
        m = merged[h, t]
        for k in (0, 1):
            by_host[h, m][k] += x[k]
            general[m][k] += x[k]
            if t != m:
                general[t][k] += x[k]
    total = [sum(x[k] for x in stats.values()) for k in (0, 1)]
    prior = total[1] / max(total[0], 1)
    out = []
    for h, p, _, verdict in rows:
        m = merged[h, tuple(template[h, p])]
        over_all = (general[m][1] + smoothing * prior) / (general[m][0] + smoothing)
        purity = (by_host[h, m][1] + smoothing * over_all) / (by_host[h, m][0] + smoothing)
        out.append(("".join(f"/{s}" for s in m), verdict or ("block" if purity > cut else "allow")))
    return out


def _nearest_links(ids, linked):
    """Smallest id reachable, by position; null ids never name a group."""
    group = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if group[a] != group[b] and linked(a, b):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    low = {}
    for i, g in zip(ids, group, strict=True):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return [low.get(g) for g in group]


def minhash(rows, size=4, percent=80):
    sets = []
    for _, text in rows:
        w = SPACED.findall(lower(text))
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set())

    def linked(a, b):
        x, y = sets[a], sets[b]
        both = len(x & y)
        return bool(x and y) and 100 * both >= percent * (len(x) + len(y) - both)

    low = _nearest_links([doc for doc, _ in rows], linked)
    return [(doc, len(s), c, doc == c) for (doc, _), s, c in zip(rows, sets, low, strict=True)]


def alignment(rows, a_path, b_path):
    """Links as all overlapping byte ranges, one document at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tool = Tokenizer.from_file(a_path)
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=b_path)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def a_bytes(i):
        return bytes(letter[c] for c in a_tool.id_to_token(i))

    def b_bytes(i):
        p = b_tool.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()

    def ranges(sizes):
        at, out = 0, []
        for n in sizes:
            out.append((at, at + n))
            at += n
        return out

    docs, count = [], Counter()
    for doc, text in rows:
        if not text:
            docs.append((doc, [], [], [], ""))
            continue
        a = a_tool.encode(" " + text, add_special_tokens=False).ids
        b = b_tool.encode(text)
        x, y = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
        if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            docs.append((doc, [], [], [], ""))
            continue
        ra, rb = ranges(map(len, x)), ranges(map(len, y))
        links, low = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[low][1] <= s:
                low += 1
            j = low
            while j < len(rb) and rb[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        count.update(links)
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, i, j = [], 0, 0
        for cut in cuts:
            p, q = i, j
            while i < len(ra) and ra[i][1] <= cut:
                i += 1
            while j < len(rb) and rb[j][1] <= cut:
                j += 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
        docs.append((doc, a, b, links, ";".join(groups)))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for doc, a, b, links, groups in docs:
        n_best = sum(count[x] == best[x[1]] for x in links)
        digest = sha(groups) if a else ""
        out.append((doc, len(a), len(b), groups.count(";") + 1 if a else 0, len(links), n_best, sum(count[x] for x in links), digest))
    return out


def vector_codes(rows, parts=4, size=256, rounds=4):
    """(vec_id, embedding, label) rows; every distance is computed."""
    kept = [(i, [math.floor(1024 * c) for c in v], label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []
    regular = sorted(((i, v) for i, v, _ in kept if len(v) % parts == 0 and all(abs(c) < 1 << 27 for c in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(regular[0][1])
    regular = [(i, v) for i, v in regular if len(v) == dims]
    width = dims // parts

    def cut(v):
        return [v[p * width : (p + 1) * width] for p in range(parts)]

    books = [[cut(v)[p] for _, v in regular[:size]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((s - t) ** 2 for s, t in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for _, v in regular:
                x = cut(v)[p]
                members[nearest(p, x)[1]].append(x)
            new.append([[sum(c) // len(c) for c in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(books[p])])
        books = new
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    out, total = [], {}
    for i, v, label in kept:
        if len(v) != dims or any(abs(c) >= 1 << 27 for c in v):
            out.append((i, None, None, label))
            continue
        found = [nearest(p, x) for p, x in enumerate(cut(v))]
        error = sum(d for d, _ in found)
        total[label] = total.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return [(i, code, error, total.get(label), digest) for i, code, error, label in out]
