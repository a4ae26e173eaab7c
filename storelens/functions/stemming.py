"""Portuguese word stems, by the published Snowball rules."""

from __future__ import annotations

import functools
import re

VOWELS = "aeiouáéíóúâêô"
# The endings of the published rules, with nasal vowels written as vowel and tilde.
STANDARD = (
    "eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos "
    "adora ador aça~o adoras adores aço~es ante antes ância"
).split()
VERBAL = (
    "ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam eriam "
    "iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er ir as adas "
    "idas ias arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses esses isses astes estes "
    "istes is ais eis íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis ésseis ísseis áveis ados idos ámos "
    "amos íamos aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos eremos iremos ássemos êssemos íssemos imos "
    "armos ermos irmos eu iu ou ira iras"
).split()


def _after(word: str, start: int) -> int:
    """Where the region after the first consonant that follows a vowel begins, from ``start`` on."""
    found = re.compile(f"[{VOWELS}][^{VOWELS}]").search(word, start)
    return found.end() if found else len(word)


def _verb_region(word: str) -> int:
    if len(word) < 3:
        return len(word)
    if word[1] not in VOWELS:
        found = re.compile(f"[{VOWELS}]").search(word, 2)
    elif word[0] in VOWELS:
        found = re.compile(f"[^{VOWELS}]").search(word, 2)
    else:
        return 3
    return found.end() if found else len(word)


def _longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


_SPECIAL = ("logia", "logias", "uça~o", "uço~es", "ência", "ências", "amente", "mente", "idade", "idades", "iva", "ivo", "ivas", "ivos", "ira", "iras")


def _standard(word: str, r1: int, r2: int, rv: int) -> str:
    ending = _longest(word, (*STANDARD, *_SPECIAL))
    if ending is None:
        return word
    stem = word[: len(word) - len(ending)]
    inside = lambda region: len(stem) >= region

    def less(stem: str, *more: str) -> str:
        """The stem without one of the endings, if that lies in the second region."""
        found = _longest(stem, more)
        return stem[: -len(found)] if found and len(stem) - len(found) >= r2 else stem

    if ending in ("ira", "iras"):
        return stem + "ir" if inside(rv) and stem.endswith("e") else word
    if ending == "amente":
        if not inside(r1):
            return word
        short = less(stem, "iv", "os", "ic", "ad")
        return less(short, "at") if stem.endswith("iv") and short != stem else short
    if not inside(r2):
        return word
    if ending in ("logia", "logias"):
        return stem + "log"
    if ending in ("uça~o", "uço~es"):
        return stem + "u"
    if ending in ("ência", "ências"):
        return stem + "ente"
    if ending == "mente":
        return less(stem, "ante", "avel", "ível")
    if ending in ("idade", "idades"):
        return less(stem, "abil", "ic", "iv")
    if ending in ("iva", "ivo", "ivas", "ivos"):
        return less(stem, "at")
    return stem


@functools.lru_cache(maxsize=100_000)
def portuguese_stem(word: str) -> str:
    """The stem of a lower-case word."""
    word = word.replace("ã", "a~").replace("õ", "o~")
    r1 = _after(word, 0)
    r2, rv = _after(word, r1), _verb_region(word)
    done = _standard(word, r1, r2, rv)
    if done == word:
        ending = _longest(word[rv:], VERBAL)
        done = word[: -len(ending)] if ending else word
    if done != word:
        if done.endswith("ci") and len(done) - 1 >= rv:
            done = done[:-1]
    else:
        ending = _longest(word[rv:], ("os", "a", "i", "o", "á", "í", "ó"))
        done = word[: -len(ending)] if ending else word
    if done[-1:] in ("e", "é", "ê") and len(done) - 1 >= rv:
        done = done[:-1]
        if done.endswith(("gu", "ci")) and len(done) - 1 >= rv:
            done = done[:-1]
    elif done.endswith("ç"):
        done = done[:-1] + "c"
    return done.replace("a~", "ã").replace("o~", "õ")
