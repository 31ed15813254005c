"""Fixed values that results depend on: patterns, masks, word lists and thresholds.

``UNICODE`` goes before a pattern for Spark, so that ``\\d`` and ``\\s`` know all digits and spaces; the SQL of the oracles uses the patterns as they are.
"""

from __future__ import annotations

UNICODE = "(?U)"

# Masks.
EMAIL_MASK = "|||EMAIL_ADDRESS|||"
PHONE_MASK = "|||PHONE_NUMBER|||"
IP_MASK = "|||IP_ADDRESS|||"

# Patterns of personal data.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = "|".join(
    [
        r"\+\d{1,3}[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
        r"\(\d{3}\)[-.\s]?\d{3}[-.\s]?\d{4}\b",
        r"\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b",
        r"\b\d{10}\b",
    ]
)
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IPV4 = r"\b" + r"\.".join([OCTET] * 4) + r"\b"

# HTML marks.
PARTIAL_TAG = r"<(div|span|p|a|img|table|tr|td|ul|ol|li|h[1-6]|br|hr|script|style|head|body|meta|link|form|input|button|nav|header|footer|section|article)\b"
GENERIC_TAG = r"<[a-zA-Z][a-zA-Z0-9]*(?:\s+[^>]*)?>.*?</[a-zA-Z][a-zA-Z0-9]*>"

# Gopher tokens, stop words, bullets.
GOPHER_WORD = r"[A-Za-z]+(?:'[A-Za-z]+)*"
GOPHER_TOKEN = r"[A-Za-z]+(?:'[A-Za-z]+)*|[0-9]+(?:\.[0-9]+)*|\S"
STOP_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with"]
BULLET = "[-•●○▪▸►◦*→⁃‣⦿⦾]"

#: What Python's str.strip and str.split take as white space.
SPACE = r"[\s\x1c-\x1f]"

# Language names.
LANGUAGE_NAMES = {
    "en": "English",
    "zh": "Chinese",
    "es": "Spanish",
    "ar": "Arabic",
    "pt": "Portuguese",
    "ja": "Japanese",
    "de": "German",
    "fr": "French",
    "ru": "Russian",
    "ko": "Korean",
    "it": "Italian",
    "nl": "Dutch",
    "pl": "Polish",
    "tr": "Turkish",
    "vi": "Vietnamese",
    "th": "Thai",
    "id": "Indonesian",
    "cs": "Czech",
    "ro": "Romanian",
    "hu": "Hungarian",
    "el": "Greek",
    "he": "Hebrew",
    "sv": "Swedish",
    "da": "Danish",
    "fi": "Finnish",
    "no": "Norwegian",
    "uk": "Ukrainian",
    "hi": "Hindi",
    "bn": "Bengali",
    "fa": "Persian",
    "unknown": "Unknown",
}
