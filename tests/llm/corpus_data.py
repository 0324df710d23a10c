"""Documents that operators must cope with."""

import random
import string

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, syllables=("ba", "ke", "mi", "lo", "tu", "ran", "sel", "dor")):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
    return "".join(w + (".\n" if i % 12 == 11 else " ") for i, w in enumerate(made)).strip()


def document_rows():
    """Copies, near copies, NULLs in every column, empty, wordless and very long texts."""
    long = prose(99, 30_000)
    rows = [(i, prose(i, 40 + 5 * i), ["en", "de", None][i % 3], ["a", "b", None][i % 3]) for i in range(20)]
    rows += [(100 + i, prose(3, 400), "en", "a") for i in range(6)]
    rows += [(120 + i, prose(3, 400) + f" {string.ascii_lowercase[i]}", "en", "b") for i in range(4)]
    rows += [(7, prose(7, 75), "de", "b"), (7, prose(7, 75), "de", "b"), (7, prose(8, 75), "de", "b")]
    rows += [(None, prose(50, 90), "en", "a"), (None, prose(51, 90), None, None), (None, None, None, None)]
    rows += [(200, "", "en", "a"), (201, " \n\t ", "en", "a"), (202, None, "en", "b"), (203, "!!! ??? 123", "en", "a")]
    rows += [(204, long, "en", "a"), (205, "one", "de", "b"), (206, "one two", "de", "b"), (207, "été naïve \U0001f600 中文", "de", "c")]
    rows += [(208, "x " * 80, "en", "a"), (209, "Tail words " + "shared line here\n" * 4 + prose(209, 60), "en", "a")]
    return [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]


#: Names that operators use inside or return.
CLASHING = (
    "row key text_key fingerprint component_id kept n_words lines host size sid start slot taken language __body __m fp "
    "h removed score entropy statistics length piece sequence_id offset id src at digest payload cell home embedding_ units"
).split()
