"""Small hard-case documents and brute-force versions for the corpus operators."""

import hashlib
import random
import re
from collections import Counter

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, b string, low string, _t string"


def texts():
    """Null, empty, blank, short, long, repeated, near-equal and odd texts."""
    rnd = random.Random(5)
    vocab = ["w%d" % k for k in range(400)] + ["Été", "straße", "naïve", "日本", "don't", "l'eau", "a.b", "x", "É", "3,5", "—", "A", "THE"]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    base, other = prose(300), prose(120)
    edited = base.split()
    edited[150] = "changed"
    far = base.split()
    for k in range(0, 300, 4):
        far[k] = f"new{k}"
    passage = prose(60)
    return [None, "", " \t\n", "one", "one two", "One  TWO\n", "same same same same same same", base, base, base.upper(), " ".join(edited), " ".join(far), other,
            prose(30) + " " + passage + " " + prose(40), passage + "\n" + prose(80), prose(20) + "\n" + passage, prose(9000), "a b c " * 400, "\n".join(["line one here"] * 30 + ["\u00a0", ""]),
            "### $$$ && " * 60, "SHOUT LOUD! " * 60 + prose(20), "x" * 70000, "\x1c\x85\u2003 odd\x00space", "e\u0301 combining E\u0301", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "🙂🙂 emoji 10 000 v2.0!!"]


def rows(extra=()):
    out = [(k, t, "en", "s", len(t or ""), "n", "b", "low", "t") for k, t in enumerate([*texts(), *extra])]
    return [*out, out[7], out[1]]          # repeated rows


def frame(spark, extra=()):
    return spark.createDataFrame(rows(extra), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return WORD.findall(t or "")


def measures(t):
    w = words(t)
    c = Counter(zip(w, w[1:], w[2:]))
    hit = {k + j for k, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for j in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)


def shingles(t, width):
    w = words((t or "").translate(TABLE))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(ids_texts, width, percent):
    sets = {i: shingles(t, width) for i, t in ids_texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def hits(t, items, window=13):
    norm = lambda x: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(TABLE))
    w, cover, found = norm(t), set(), set()
    for i, x in items:
        v = norm(x)
        for k in range(max(len(v) - window, 0) + 1 if v else 0):
            part = v[k:k + window]
            for a in range(len(w) - len(part) + 1):
                if w[a:a + len(part)] == part:
                    cover.update(range(a, a + len(part)))
                    found.add(i)
    return len(w), len(cover), found


def without_repeats(all_texts, window):
    """Of each text: words, words removed, digest of the rest."""
    count = Counter()
    for t in all_texts:
        w = words(t)
        count.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = []
    for t in all_texts:
        w = words(t)
        gone = {k + j for k in range(len(w) - window + 1) if count[tuple(w[k:k + window])] > 1 for j in range(window)}
        rest = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def library_ids(text, path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
