"""Text fixtures shared by the tests of the subpackage."""

import random

SYLLABLES = "ka lo mi ter on sa ri ven du pol est ar in qué tö ßen".split()


def sentence(rng, n):
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def text(rng, n):
    out, left = [], n
    while left > 0:
        k = min(left, rng.randint(4, 18))
        out.append(sentence(rng, k))
        left -= k
    return "\n".join(" ".join(out[i:i + 3]) for i in range(0, len(out), 3))


def edited(rng, t, share):
    words = t.split(" ")
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = "".join(rng.choices(SYLLABLES, k=3))
    return " ".join(words)


def corpus(seed=5, n=60):
    """Random documents, exact and near copies, shared passages, repeated junk, and the edge cases."""
    rng = random.Random(seed)
    base = [text(rng, rng.randint(5, 260)) for _ in range(n)]
    passage = text(rng, 80)
    rows = list(base)
    rows += [base[i] for i in (0, 0, 0, 3, 5)]                                     # exact copies
    rows += [edited(rng, base[i], s) for i in (1, 1, 2, 2, 4, 6) for s in (0.005, 0.02, 0.05, 0.1)]
    rows += [edited(rng, edited(rng, base[7], 0.01), 0.01) for _ in range(12)]      # a larger group
    rows += [text(rng, 40) + "\n" + passage + "\n" + text(rng, 30) for _ in range(6)]
    rows += ["ab " * 400, "ab " * 300, "la la la la " * 90 + passage, "z" * 5000, "z" * 4000 + " " + passage]
    rows += ["", None, " \n\t ", "one", "One", "two words", "three little words", "a\nb\na\nb\na"]
    rows += ["zero\x00byte " + passage[:200], "emoji \U0001F600 " + passage[100:400], text(rng, 30000)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    out = [(10 + 3 * k, rows[i]) for k, i in enumerate(order)]
    out += [(None, base[0]), (None, "no key at all " + passage), out[4], out[4]]       # null keys, repeated rows
    return out


LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LAST = 1 << 62


def data(t):
    return (t or "").encode()
