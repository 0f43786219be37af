"""Options of the feature pipeline."""

from __future__ import annotations

from dataclasses import dataclass, replace

PATH_FORMATS = ("pos", "word_pos_label", "word_label")
NOUN_RULES = ("descriptor", "pos")
STEM_SCOPES = ("word", "descriptor")
PAIR_SCOPES = ("all", "first_half")
LABEL_RULES = ("any_true", "drop_conflicts")


@dataclass(frozen=True)
class Options:
    """What to compute.

    dpmin          paths linking fewer distinct ordered pairs are dropped
    path_format    how a path is written: ``NN-VB-NN`` (pos),
                   ``X/NN/prep-as/IN/dep-X/NN/pobj`` (word_pos_label) or
                   ``X/prep-as/dep-X/pobj`` (word_label)
    noun_on        ``NN`` anywhere in the token, or in its part of speech only
    stem_scope     stem the word field only, or every occurrence of the word
                   in its token
    pair_scope     every noun pair of a line, or only pairs whose earlier noun
                   is in the first half of the line's nouns
    symmetric      a pair also gets the evidence of its flipped pair
    label_rule     a pair labelled both ways is true, or is dropped
    lower          lower-case words before stemming
    unrolled_hops  walks up to this many hops run as plain columns; longer
                   lines take the array form, with the same result. Beyond 6
                   the generated method outgrows the JVM's limit for compiled
                   methods and the walk gets slower.
    """

    dpmin: int = 750
    path_format: str = "pos"
    noun_on: str = "descriptor"
    stem_scope: str = "word"
    pair_scope: str = "all"
    symmetric: bool = True
    label_rule: str = "any_true"
    lower: bool = False
    unrolled_hops: int = 5

    def __post_init__(self) -> None:
        if self.dpmin < 1:
            raise ValueError("dpmin must be at least 1")
        if not 1 <= self.unrolled_hops <= 60:
            raise ValueError("unrolled_hops must be within 1..60")
        for name, allowed in (
            ("path_format", PATH_FORMATS),
            ("noun_on", NOUN_RULES),
            ("stem_scope", STEM_SCOPES),
            ("pair_scope", PAIR_SCOPES),
            ("label_rule", LABEL_RULES),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")

    def but(self, **changes) -> Options:
        return replace(self, **changes)


# Line semantics of the original batch jobs, quirks included.
COMPATIBLE = Options(stem_scope="descriptor", pair_scope="first_half")
