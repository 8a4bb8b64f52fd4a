import pytest
from docledger.llm import pii


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("my ssn 219-09-9999", True),
        ("the latest ssn 219-09-9999", True),
        ("ssn 219-09-9999, contested in court", True),
        ("SSN: 219-09-9999", True),
        ("a test ssn 219-09-9999", False),
        ("example: social security 219-09-9999", False),
        ("lessn 219-09-9999", False),
        ("ssns 219-09-9999", False),
        ("219-09-9999", False),
    ],
)
def test_context_is_of_whole_words(text, found):
    assert bool(pii.spans(text)) == found


def test_scores_move_by_whole_words_within_reach():
    base = pii.PRIOR["phone"]
    assert pii.score("phone", "hotel +1 234 567 8901", 6, 21) == base
    assert pii.score("phone", "tel +1 234 567 8901", 4, 19) == base + 0.25
    assert pii.score("ip", "the ship 10.0.0.1", 9, 17) == pii.PRIOR["ip"]
    # a word that the reach cuts is none: "contest" does not end in a doubt
    text = "contest" + " " * 36 + "+1 234 567 8901"
    assert pii.score("phone", text, 43, 58) == base
