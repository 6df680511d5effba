"""Plain Python versions of the operators' digests, one document at a time."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(docs, items, window=10):
    """docs, items: (id, text). Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    grams = defaultdict(set)
    for item, text in items:
        words = TERM.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            grams[tuple(words[k : k + n])].add(str(item))
    sizes = sorted({len(g) for g in grams})
    for doc, text in docs:
        words = TERM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if g := grams.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= g
        yield doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def nearby(docs, items, slop=5, least=5):
    """{doc_id: ids of items all of whose different words stand within the item's length plus ``slop`` words}, by every stretch."""
    out = defaultdict(set)
    for doc, text in docs:
        words = TERM.findall((text or "").translate(LOWER))
        for item, item_text in items:
            own = TERM.findall((item_text or "").translate(LOWER))
            span = len(own) + slop
            if len(set(own)) >= least and set(own) <= set(words) and any(set(own) <= set(words[k : k + span]) for k in range(max(1, len(words) - span + 1))):
                out[doc].add(str(item))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(docs):
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256)."""
    only = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(only(s)) <= 15),
    }
    for doc, text in docs:
        found = [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]
        n = Counter(k for k, _, _ in found)
        yield doc, *(n[k] for k in kinds), sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))


def deduped_lines(docs, ratio_pct=7, min_pages=5):
    """docs: (id, text, site). Rows (doc_id, n_lines, n_dropped, text)."""
    pages, counts = Counter(), Counter()
    for _, text, site in docs:
        pages[site] += 1
        counts.update((site, x) for x in {x for x in (text or "").split("\n") if WORD.search(x)})
    bad = {k for k, n in counts.items() if n >= min_pages and n * 100 > pages[k[0]] * ratio_pct}
    for doc, text, site in docs:
        if text is None:
            yield doc, 0, 0, None
            continue
        lines = text.split("\n")
        kept = [x for x in lines if (site, x) not in bad]
        yield doc, len(lines), len(lines) - len(kept), "\n".join(kept)


def licensed(docs, templates, threshold=80):
    """templates: (identifier, notice). Rows (doc_id, license_id, dice, n_license_lines)."""

    def bigrams(line):
        w = "".join(c if c.isascii() and c.isalnum() else " " for c in line.translate(LOWER)).split()
        return set(zip(w, w[1:], strict=False))

    forms = [(k, bigrams(x)) for k, x in templates]
    for doc, text in docs:
        tops = []
        for line in (text or "").split("\n"):
            a = bigrams(line)
            scores = [(2.0 * len(a & b) / (len(a) + len(b)), -k) for k, (_, b) in enumerate(forms)]
            if 100 * max(scores)[0] >= threshold:
                tops.append(max(scores))
        yield doc, forms[-max(tops)[1]][0] if tops else None, round(max(tops)[0], 6) if tops else 0.0, len(tops)


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(docs, pct=75):
    """docs: (id, text). Rows (doc_id, n_shingles, component_id)."""
    sets = {doc: shingles(text) for doc, text in docs}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders, common = defaultdict(list), Counter()
    for doc, own in sets.items():
        for s in own:
            holders[s].append(doc)
    for held in holders.values():
        common.update((a, b) for k, a in enumerate(held) for b in held[:k])
    for (a, b), n in common.items():
        if 100 * n >= pct * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    for doc, own in sets.items():
        yield doc, len(own), find(doc)


def quality(docs):
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    for doc, text in docs:
        words = WORD.findall(text or "")
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        n = len(words)
        yield doc, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def targets(docs, weights=(3, 1, 2), share=1.5, most=2):
    """docs: (id, text, source). {source: (source_size, target)}."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), list(names)
    while free:
        each = left / sum(w[s] for s in free)
        over = [s for s in free if each * w[s] > most * sizes[s]]
        if not over:
            target |= {s: each * w[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return {s: (sizes[s], target[s]) for s in names}


def kept(docs):
    """{doc_id: whether the base and all six rules let the text pass}, one rule after another."""
    out = {}
    for row, (doc, text) in zip(quality(docs), docs, strict=True):
        _, n, chars, symbols, dup_lines, _, failed = row
        text = text or ""
        lines = text.split("\n")
        with_letter = sum(any(c.isalpha() for c in w) for w in WORD.findall(text))
        bullets = sum(x.lstrip(" \t")[:1] in ("-", "*", "\u2022") and x.lstrip(" \t") != "" for x in lines)
        dots = sum(x.rstrip(" \t").endswith(("...", "\u2026")) for x in lines)
        fine = n and 2 <= chars / n <= 15 and symbols <= 0.3 * n and dup_lines <= 0.3 * len(lines) and with_letter >= 0.6 * n and bullets <= 0.9 * len(lines) and dots <= 0.3 * len(lines)
        out[doc] = bool(not failed and fine)
    return out


def ruled(url):
    """(host, path, rule, verdict) of a URL by the five production rules, tried one by one; the verdict is None without one."""
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fit = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    best = max(fit, key=len) if fit else None
    return host, path, best, rules.get(best)
