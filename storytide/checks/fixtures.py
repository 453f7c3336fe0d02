"""Lexicon rows and catalogue values that the registered queries use.

The corpus is invented prose, so the lexicon is made of frequent words of that corpus.
The rows are plain SQL values and serve Spark and the checking SQL alike.
"""

from __future__ import annotations

from storytide.schema import EMOTIONS

# Sixty frequent words of the test corpus.
LEXICON_WORDS = tuple(
    """
tion rewh tre orre ing thatin ononst inoran hehely orantion ble ther thth thon thhe
thha thre thnt thed thin thor thea thes thly thti erin thble thsh thst eren erhe eron
thnd thou thing erth der que die und les eau ment den ein eux von elle sch ier ung une
nci das ver los mit sich del auf
""".split()
)

# Shelves and subjects that books are given in turn.
BOOKSHELVES = (
    None,
    "",
    "Browsing: Fiction",
    "Gothic Fiction; Browsing: Fiction",
    " Science Fiction ;Best Books",
    "Children's Literature",
)
SUBJECTS = (
    None,
    "Fiction",
    "Science fiction",
    "Horror tales",
    "Fantasy literature",
    "Romances",
    "Detective and mystery stories",
    "Adventure stories; Horror tales",
    "Juvenile literature",
    "Historical drama",
    "Philosophy; Love stories, romance",
)


def emotion_rows() -> list[tuple[str, str]]:
    pairs = []
    for i, word in enumerate(LEXICON_WORDS):
        pairs.append((word, EMOTIONS[i % 8]))
        if i % 3 == 0:
            pairs.append((word, EMOTIONS[(3 * i + 1) % 8]))
        if i % 5 == 0:
            pairs.append((word, "positive"))
    return sorted(set(pairs))


def vad_rows() -> list[tuple[str, float, float, float]]:
    return [
        (word, *(((k * i) % 200 - 100) / 100 for k in (37, 53, 71)))
        for i, word in enumerate(LEXICON_WORDS)
        if i % 4 != 3
    ]


def text_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'"


def emotion_values() -> str:
    return ", ".join(f"({text_literal(w)}, {text_literal(e)}, 1)" for w, e in emotion_rows())


def vad_values() -> str:
    return ", ".join(f"('{w}', {v!r}e0, {a!r}e0, {d!r}e0)" for w, v, a, d in vad_rows())
