import numpy as np
import pytest


@pytest.fixture(scope="session")
def prose():
    """Made-up documents with copies, near copies, shared passages, blanks and nulls: (doc_id, text)."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdeéghiñlmnoöprstuvz"), rng.integers(2, 9))) for _ in range(300)]
    vocabulary += ["The", "ARE", "of", "a"]

    def sentence():
        return " ".join(rng.choice(vocabulary, rng.integers(2, 15))).capitalize() + rng.choice([".", "!", "?"])

    def text(n):
        return "".join(sentence() + rng.choice([" ", "\n", "  ", "\r\n"], p=[0.7, 0.2, 0.05, 0.05]) for _ in range(n)).rstrip()

    passages = [text(5) for _ in range(4)]
    docs = [text(int(rng.integers(1, 30))) for _ in range(60)]
    docs += [d + "\n" + passages[k % 4] + "\n" + text(3) for k, d in enumerate(docs[:24])]
    docs += docs[:6] * 3
    for d in docs[:20]:
        words = d.split(" ")
        for _ in range(max(1, len(words) // 40)):
            words[int(rng.integers(len(words)))] = "changed"
        docs.append(" ".join(words))
    docs += ["", "   ", "\n\n", "one", "one", "two words", "One", "four words in all", "A b c d e", "a b c d e", "😀 text ☃ with　signs", text(800)]
    order = rng.permutation(len(docs))
    rows = [(int(i), docs[k]) for i, k in enumerate(order)]
    return rows + [(len(rows), None), (None, docs[0]), (None, docs[3]), rows[0], rows[0], (7, "a second text of one id, long enough to count as a line of its own.")]
