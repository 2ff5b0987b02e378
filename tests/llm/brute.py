"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def leaks(docs, items, window=10):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated by comparing all windows."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    wanted = {}
    for item, text in items:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            wanted.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in wanted}
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (owners := wanted.get(tuple(words[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= owners
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), listed, bool(hit)))
    return out


ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs, window=13):
    """doc_id, n_words, n_removed, kept_sha256 by looking up every window."""
    split = [(doc, ASCII_WORD.findall(text or "")) for doc, text in docs]
    least = {}
    for doc, words in split:
        if doc is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - window + 1 if doc is not None else 0):
            if least[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near(docs, size=5):
    """doc_id, n_shingles, component_id by comparing all pairs."""
    sets = []
    for doc, text in docs:
        words = ASCII_WORD.findall((text or "").translate(LOWER))
        n = min(size, len(words))
        sets.append((doc, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()))
    parent = {doc: doc for doc, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and a is not None and b is not None:
                shared = len(s & t)
                if 100 * shared >= 80 * (len(s) + len(t) - shared):
                    ra, rb = sorted((root(a), root(b)))
                    parent[rb] = ra
    return [(doc, len(s), None if doc is None else root(doc)) for doc, s in sets]


def order_likeness(a, b, k=3, picked=2, seeds=300):
    """Order MinHash with a hash function per selection, on lists of tokens."""

    def numbered(tokens):
        seen, out = {}, []
        for i in range(max(1, len(tokens) - k + 1)):
            mer = tuple(tokens[i : i + k])
            seen[mer] = seen.get(mer, 0) + 1
            out.append((mer, seen[mer]))
        return out

    def select(items, seed):
        ranked = sorted(range(len(items)), key=lambda i: hashlib.md5(repr((seed, items[i])).encode()).digest())
        return [items[i] for i in sorted(ranked[:picked])]

    one, other = numbered(a), numbered(b)
    return (sum(select(one, s) == select(other, s) for s in range(seeds)) / seeds) ** (1 / picked)


def page(rng):
    """A well-formed page, and the text of its article as it was put in."""
    words = ["alpha", "beta", "gamma &amp; delta", "épsilon", "zeta&nbsp;eta", "theta", "iota", "kappa"]
    plain = lambda t: " ".join(t.replace("&amp;", "&").replace("&nbsp;", " ").split())
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    parts, kept = [], []
    for k in range(rng.randint(3, 9)):
        text = sentence(rng.randint(14, 40))
        shape = rng.randrange(4)
        if shape == 0:
            parts.append(f"<p>{text}</p>")
            kept.append(plain(text))
        elif shape == 1:
            items = [sentence(9) for _ in range(3)]
            parts.append("<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>")
            kept += map(plain, items)
        elif shape == 2:
            parts.append(f"<section><h2>Part {k}</h2><div>{text} <b>bold</b>\n  <i>end</i></div></section>")
            kept += [f"Part {k}", plain(text) + " bold end"]
        else:
            parts.append(f"<blockquote><p>{text}</p></blockquote><script>if (a < {k}) b('</p>')</script>")
            kept.append(plain(text))
    links = "".join(f"<li><a href='/{k}'>{sentence(2)}</a></li>" for k in range(6))
    article = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class='outer'><article>{}</article></div>"])
    html = (
        f"<html><head><title>{sentence(3)}</title><style>p {{ margin: 0 }}</style></head><body><header>{sentence(4)}</header>"
        f"<nav><ul>{links}</ul></nav><div class='ad'>{sentence(12)}</div>{article.format(''.join(parts))}"
        f"<aside>{sentence(20)}</aside><div class='comments'><p>{sentence(15)}</p></div><footer>{sentence(5)}</footer></body></html>"
    )
    return html, "\n\n".join(kept)
