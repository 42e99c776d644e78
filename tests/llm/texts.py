"""Random texts with shared passages, copies, near copies and odd cases."""

import random


def prose(rng, n, vocabulary=400):
    return " ".join("w%d" % rng.randrange(vocabulary) for _ in range(n))


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [prose(rng, 70) for _ in range(3)]
    out = []
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0 and out:
            text = rng.choice(out)[1]
        elif kind == 1 and out:
            words = (rng.choice(out)[1] or "").split(" ")
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = "changed%d" % rng.randrange(50)
            text = " ".join(words)
        elif kind == 2:
            text = prose(rng, rng.randrange(60)) + "\n" + rng.choice(passages) + "\t " + prose(rng, rng.randrange(60))
        elif kind == 3:
            text = rng.choice(["", None, "   \n", "one", "One two", "é" * 40, "the " * 80, "a b c d", "A B C D"])
        else:
            text = prose(rng, rng.randrange(200))
        out.append((i * 3 % 101, text))
    out += [out[0], out[1], (None, passages[0]), (None, None)]
    return out
