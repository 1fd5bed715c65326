"""Values that must be exactly so, stated apart from the code that uses them."""

from screenmart.functions.steps import STEPS
from screenmart.functions.text import LANGUAGES
from screenmart.plans.firstgen import BENEFIT_LABELS, WIDE_PROGRAMS


def test_wide_programs():
    flags = dict(WIDE_PROGRAMS)
    assert len(WIDE_PROGRAMS) == len(flags) == 113
    assert [p for p, tax in WIDE_PROGRAMS if tax] == [
        "coctc", "coeitc", "eitc", "fatc", "ma_maeitc", "il_ctc", "il_eitc", "shitc",
    ]
    assert [p for p, tax in WIDE_PROGRAMS if tax is None] == ["upk"]


def test_benefit_labels_keep_their_published_places():
    assert len(BENEFIT_LABELS) == 111 and sum(label is not None for label, _ in BENEFIT_LABELS) == 110
    assert BENEFIT_LABELS[0] == ("ACP", "acp") and BENEFIT_LABELS[-1] == (None, "wic")
    shifted = [p for _, p in BENEFIT_LABELS].index("ma_tafdc")
    assert BENEFIT_LABELS[shifted - 1] == ("MA TAFDC", "ma_ssp") and BENEFIT_LABELS[shifted] == ("MA WIC", "ma_tafdc")


def test_languages_and_steps():
    assert len(LANGUAGES) == 100
    assert {LANGUAGES["en-us"], LANGUAGES["es"], LANGUAGES["vi"]} == {"English", "Spanish", "Vietnamese"}
    slugs = [s for s, *_ in STEPS]
    assert len(slugs) == len(set(slugs))
    assert sorted(r for *_, r, _ in STEPS if r is not None) == list(range(1, 13))
