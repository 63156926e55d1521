"""Small fixtures that hold the hard cases, and brute-force counterparts."""

import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, block int, label array<int>"


def words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return WORD.findall(text)


def vocabulary(rng, size=400):
    return ["".join(rng.choices("abcdeäñ", k=rng.randint(2, 6))) for _ in range(size)]


def texts(seed=1, count=60):
    """Random texts with passages, near copies, exact copies, odd spaces, empty and null ones."""
    rng = random.Random(seed)
    vocab = vocabulary(rng)
    passage = " ".join(rng.choices(vocab, k=40))
    out = []
    for k in range(count):
        kind = k % 6
        if kind == 1 and out:
            own = words(out[-1])
            for _ in range(len(own) // 30):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            out.append(" ".join(own))
        elif kind == 2 and len(out) > 3:
            out.append(out[rng.randrange(len(out))])
        else:
            own = rng.choices(vocab, k=rng.randint(1, 120))
            if kind == 3:
                own.insert(rng.randrange(len(own)), passage)
            out.append(rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t", "  "]).join(own).capitalize())
    return [*out, None, "", " \n\t", "one", "Two Words", " ".join(rng.choices(vocab, k=3000)), passage, passage.upper()]


def rows(values, first=0):
    """Rows of ``documents`` with clashing extra columns; the last ones repeat, and lack an id."""
    made = [
        (first + k, t, ["en", "de", None][k % 3], f"src{k % 5}", len(t or ""), "x", k, k, [k])
        for k, t in enumerate(values)
    ]
    return [*made, made[1], made[3], (None, values[0], None, None, None, None, None, None, None), (None,) * 9]


def union_find(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
