"""Plain-Python statement of the text rules, character by character, for comparison."""

import unicodedata
from collections import Counter

# Digit words, punctuation, scripts.
WORDS = dict(zip("0123456789", "शून्य एक दो तीन चार पांच छह सात आठ नौ".split(" ")))
FOLDED = {"।": ".", "॥": ".", "‘": "'", "’": "'", "‛": "'", "“": '"', "”": '"', "„": '"'}
FOLDED |= {"–": "-", "—": "-", "…": "..."}
SCRIPTS = {
    "hi": "DEVANAGARI",
    "bn": "BENGALI",
    "te": "TELUGU",
    "ta": "TAMIL",
    "ml": "MALAYALAM",
    "kn": "KANNADA",
    "gu": "GUJARATI",
    "mr": "DEVANAGARI",
    "pa": "GURMUKHI",
    "ur": "ARABIC",
    "en": "LATIN",
}


def wordish(ch):
    return ch == "_" or ch.isalnum()


def squeeze(text):
    """White-space runs as one space, edges kept."""
    out = []
    for ch in text:
        if not ch.isspace():
            out.append(ch)
        elif not out or out[-1] != " ":
            out.append(" ")
    return "".join(out)


def normalized(text, lang):
    """(normalised text, operations, length before, length after) or None for blank text."""
    if text is None or all(ch.isspace() for ch in text):
        return None
    composed = unicodedata.normalize("NFC", text)
    bare = "".join(ch for ch in composed if unicodedata.category(ch) != "Mn")
    spelled = bare
    if lang == "hi":
        pieces = []
        for i, ch in enumerate(bare):
            alone = not (i and wordish(bare[i - 1])) and not wordish(bare[i + 1 : i + 2] or " ")
            pieces.append(WORDS[ch] if ch in WORDS and alone else ch)
        spelled = "".join(pieces)
    if lang == "en":
        low = spelled.lower()
    else:
        low = "".join(ch.lower() if ch.isascii() else ch for ch in spelled)
    folded = squeeze("".join(FOLDED.get(ch, ch) for ch in low))
    kept = "".join(ch for ch in folded if wordish(ch) or ch == " " or ch in ".,!?-'\"")
    final = squeeze(kept).strip()
    flags = [
        ("unicode_nfc", text != composed),
        ("diacritics_removed", composed != bare),
        ("numbers_expanded", bare != spelled),
        ("punctuation_normalized", low != kept),
    ]
    return final, [name for name, on in flags if on], len(text), len(final)


def metrics(text):
    words = text.split()
    if not words:
        return 0.0, 0, 0, 0.0, 1.0, 0.0
    n = len(words)
    mean = sum(map(len, words)) / n
    repeated = (n - len(set(words))) / n
    marks = sum(not (ch.isalnum() or ch.isspace()) for ch in text)
    score = 1.0 * (0.3 if repeated > 0.7 else 1.0) * (0.5 if n < 3 else 1.0)
    score *= 0.7 if mean < 2 else 1.0
    return score, n, len(text), mean, repeated, marks / len(text)


def script(text, lang):
    if not text.split():
        return False, 0.0, "empty"
    tokens = [
        (unicodedata.name(ch, "") or "UNKNOWN").split(" ")[0] for ch in text if ch.isalpha()
    ]
    if not tokens:
        return False, 0.0, "no_alpha"
    # most_common keeps first-seen order among equals
    token, n = Counter(tokens).most_common(1)[0]
    share = n / len(tokens)
    expected = SCRIPTS.get(lang, "UNKNOWN")
    if token not in expected and expected not in token:
        return False, share, token
    return share > (0.7 if lang == "en" else 0.5), share, token
