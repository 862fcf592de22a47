"""Labelled findings that no pattern of the scanner made: planted secrets and look-alikes.

A finding is (before, value, after). Secrets are of many shapes: random strings of several
alphabets and lengths, with vendor-like prefixes, in dotted segments, and short passwords after
a name. Look-alikes are what ordinary texts hold instead: dates, versions, numbers, mails, paths,
addresses, identifiers, and plain words after the same names. Both stand in contexts
taken from the corpus, so that the surroundings alone tell nothing, or after a name.
"""

from __future__ import annotations

import numpy as np

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_MARKS = "!@#$%^&*-_."
NAMES = ("pwd", "pass", "passphrase", "auth", "credential", "credentials", "login", "pin code", "access key", "private key", "signing key",
         "client_key", "license key", "bearer", "Authorization", "DB_PASS", "session", "webhook", "connection key", "recovery code")
PLAIN_NAMES = ("date", "phone", "version", "size", "page", "id", "mail", "host", "file", "user", "title", "name", "number", "ref", "color")
WORDS = ("required", "disabled", "enabled", "unknown", "optional", "changed", "expired", "incorrect", "missing", "protected", "default", "forgotten",
         "management", "authentication", "development", "information", "environment", "configuration", "the following", "see below")
JOINTS = (": ", "=", " = ", ":", ': "', "='", " is ", " ")


def _some(rng: np.random.Generator, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choice(list(alphabet), int(rng.integers(low, high + 1))))


def _word(rng: np.random.Generator, low: int = 3, high: int = 9) -> str:
    """A word that can be spoken: consonants and vowels in turn."""
    letters = (rng.choice(list("bcdfghklmnprstvw")) if i % 2 else rng.choice(list("aeiou")) for i in range(int(rng.integers(low, high + 1))))
    return "".join(letters)


def _password(rng: np.random.Generator) -> str:
    if rng.random() < 0.5:
        return _some(rng, _LOWER + _UPPER + _DIGITS + _MARKS, 8, 16)
    return _word(rng, 4, 7).capitalize() * int(rng.random() < 0.7) + _some(rng, _DIGITS, 2, 4) + str(rng.choice(list(_MARKS))) + _some(rng, _LOWER + _UPPER + _DIGITS, 2, 5)


def _key(rng: np.random.Generator) -> str:
    every = _LOWER + _UPPER + _DIGITS
    shape = rng.integers(6)
    if shape == 0:
        return _some(rng, every, 20, 64)
    if shape == 1:
        return _some(rng, _LOWER, 2, 5) + str(rng.choice(["_", "-"])) + _some(rng, every, 20, 44)
    if shape == 2:
        return _some(rng, every + "+/", 24, 60) + "=" * int(rng.integers(3))
    if shape == 3:
        return ".".join(_some(rng, every + "-_", 12, 40) for _ in range(int(rng.integers(2, 4))))
    if shape == 4:
        return _some(rng, _UPPER + _DIGITS, 18, 32)
    return _some(rng, _LOWER, 2, 4) + "-" + _some(rng, _LOWER, 2, 5) + "-" + _some(rng, every + "-_", 20, 40)


def _lookalike(rng: np.random.Generator) -> str:
    number = lambda low, high: _some(rng, _DIGITS, low, high)
    shape = rng.integers(10)
    if shape == 0:
        return f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    if shape == 1:
        return ".".join(number(1, 3) for _ in range(int(rng.integers(3, 5))))
    if shape == 2:
        return number(6, 18)
    if shape == 3:
        return f"{_word(rng)}.{number(1, 2)}@{_word(rng)}{number(0, 1)}.{_word(rng, 2, 3)}"
    if shape == 4:
        return "/".join(_word(rng) for _ in range(int(rng.integers(2, 6)))) + f".{_word(rng, 2, 3)}"
    if shape == 5:
        return f"{number(3, 3)}-{number(4, 4)}" + str(rng.choice(["", "!!", "###"]))
    if shape == 6:
        return _word(rng) + "".join(_word(rng).capitalize() for _ in range(int(rng.integers(1, 4)))) + number(0, 2)
    if shape == 7:
        return "_".join(_word(rng) for _ in range(int(rng.integers(2, 5))))
    if shape == 8:
        return "-".join(_word(rng) for _ in range(int(rng.integers(2, 6)))) + "-" + number(1, 4)
    return _word(rng, 12, 24) + str(rng.choice(["", "$$$", "%%%", "***"]))


def planted(n: int, contexts: list[tuple[str, str]], seed: int = 11) -> tuple[list[tuple[str, str, str]], list[bool]]:
    """``n`` findings and whether each is a secret; half of them are. ``contexts`` are (before, after) of places in the corpus."""
    rng = np.random.default_rng(seed)
    contexts = contexts or [("", "")]
    out, labels = [], []
    for i in range(n):
        before, after = contexts[int(rng.integers(len(contexts)))]
        secret, named = i % 2 == 0, rng.random() < 0.5
        joint = str(rng.choice(JOINTS))
        if secret and named and rng.random() < 0.5:
            value = _password(rng)
        elif secret:
            value = _key(rng)
        elif named and rng.random() < 0.3:
            value = str(rng.choice(WORDS)).split()[0]
        else:
            value = _lookalike(rng)
        if named:
            # plain words and look-alikes stand after either kind of name, secrets after their own
            name = str(rng.choice(NAMES if secret or value in WORDS else PLAIN_NAMES))
            before = f"{before} {name.upper() if rng.random() < 0.2 else name}{joint}"
            after = (joint[-1] if joint[-1] in "\"'" else "") + after
        out.append((before, value, after))
        labels.append(secret)
    return out, labels
