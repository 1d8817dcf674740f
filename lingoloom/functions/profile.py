"""What the operators know about a language."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# fixed values
WEIGHTS = {
    "ambig": 10.0,
    "cond_ctx": 8.0,
    "cond_word": 6.0,
    "vowel_harmony_word": 6.0,
    "cond_letter": 5.0,
    "vowel_harmony": 2.0,
    "char4": 2.0,
    "char3": 1.5,
    "char2": 1.0,
    "word": 0.8,
    "deterministic_letter": 0.5,
    "meta": 0.5,
    "style": 0.3,
}
#: Latin letters and signs that a transliterated text may hold.
LATIN_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZäÄöÖüÜñÑıİğĞşŞçÇ-—ʼ"


@dataclass(frozen=True)
class LanguageProfile:
    """Letters and patterns; the defaults are those of Tatar in Cyrillic."""

    # fixed values
    letters: str = "А-Яа-яЁёӘәӨөҮүҖҗҢңҺһ"
    upper: str = "А-ЯЁӘӨҮҖҢҺ"
    lower: str = "а-яёәөүҗңһ"
    conditional: str = "уүгквяюец"
    deterministic: str = "әөҗңһ"
    specific: str = "әөүҗңһ"
    front: str = "әеөүи"
    back: str = "аоуы"
    foreign: str = "ёщъь"
    review: str = "ёыьъщ"
    #: What stands before a dot that doesn't end a sentence; matched at the end of what precedes it.
    abbreviations: tuple[str, ...] = ("б", "г", "д", "с", "ел", "елл", "т ?[.\u0002] ?п", "т ?[.\u0002] ?е", "им", "ул", "пр", "стр", "см", "проф", "доц", "д-р")
    min_specific_per_word: float = 0.12
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS), hash=False)

    @property
    def word(self) -> str:
        return f"{self.letter}+"

    @property
    def letter(self) -> str:
        """A character class of the letters that tries its ranges first, then the single letters: Java tries a flat class in full for each character."""
        ranges, singles = re.findall(".-.", self.letters), re.sub(".-.", "", self.letters)
        return f"[{''.join(reversed(ranges))}{f'[{singles}]' if singles else ''}]"


TATAR = LanguageProfile()
