"""Fixed word lists and character classes the results depend on."""

# The 127-word English stop list of the 2015 corpus release.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom this
    that these those am is are was were be been being have has had having do does did doing a an
    the and but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very s t can will just don should now
    """.split()
)

# ASCII punctuation without the sentence marks ? ! and .
PUNCTUATION = "\"#$%&'()*+,-/:;<=>@[\\]^_`{|}~"

# ASCII white space of a byte-string pattern, and the further code points that
# separate words in decoded text.
ASCII_SPACE = r" \t\n\x0B\f\r"
UNICODE_SPACE = (
    r"\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Words the Treebank tokenizer cuts in two (first half, second half).
CONTRACTIONS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
)
# Cut only when white space follows.
SPACED_CONTRACTION = ("wan", "na")

# Words with a stem of their own in the extended Porter algorithm.
IRREGULAR_STEMS = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
