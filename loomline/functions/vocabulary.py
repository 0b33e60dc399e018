"""Word lists and templates."""

from __future__ import annotations

# Word lists, aliases and question templates that results must agree on.
TAG_STOPWORDS = (
    "about after against because before being could every going host maybe other really should their there these thing those "
    "under where which would"
).split()
TOPIC_STOPWORDS = (
    "a an and apologizes asks asked because coherent day episode general good great homebrew how issues like only maybe more other "
    "over plan podcast quest really says show speaker speakers start starting talk talked talking technical the their there thing "
    "things this than unknown very voodoo were when will without"
).split()
SHORT_LABELS = ["ai", "uk", "us"]
GENERIC_LABELS = (
    "acknowledges advocate advocates argue argues assert asserts believe believes calls comments compares criticize criticizes "
    "criticise criticises describes discuss discusses expresses explains introduces mention mentions notes oppose opposes question "
    "questions recommends responds says suggests support supports talks thinks uses warns despite lack using over only than when were "
    "will without"
).split()
TOPIC_ALIASES = {
    "artificial intelligence": "ai",
    "federal reserve": "fed",
    "fed reserve": "fed",
    "federal reserve inflation": "fed",
    "russia ukraine": "ukraine war",
    "russia ukraine war": "ukraine war",
    "ukraine": "ukraine war",
    "us": "u.s.",
    "u s": "u.s.",
}
META_VERBS = {
    "advocate": "advocate advocates support supports promote promotes".split(),
    "criticize": "criticize criticizes criticise criticises oppose opposes".split(),
    "question": "question questions challenge challenges doubt doubts".split(),
    "discuss": "discuss discusses mention mentions talk talks describe describes".split(),
    "believe": "believe believes think thinks argue argues assert asserts".split(),
}
POLICY_KEYWORDS = ["policy", "regulation", "law", "tax", "tariff", "fed"]
META_QUESTIONS = {
    "advocate": [
        "What subjects does the host advocate for most strongly?",
        "What positions does the host push most consistently?",
        "Where does the host sound most committed or forceful?",
    ],
    "criticize": [
        "What subjects does the host criticize most strongly?",
        "What recurring objections does the host make?",
        "Where does the host sound most dismissive or hostile?",
    ],
    "question": [
        "What subjects does the host question or challenge most often?",
        "What assumptions does the host push back against?",
        "Where does the host sound most skeptical?",
    ],
    "discuss": [
        "What subjects does the host spend the most time discussing?",
        "What themes recur most often in the corpus?",
        "What topics keep resurfacing across episodes?",
    ],
    "believe": [
        "What beliefs does the host return to most often?",
        "What core assumptions seem to shape the host's worldview?",
        "What positions appear most consistent across episodes?",
    ],
}
POLICY_QUESTIONS = [
    "What policy positions does the host take on {}?",
    "How has the host's framing of {} changed over time?",
    "What tradeoffs or objections recur in the corpus about {}?",
]
SUBJECT_QUESTIONS = [
    "What are the host's views on {}?",
    "How have the host's views on {} changed over time?",
    "What arguments recur in the corpus about {}?",
]
META_HINTS = {
    "advocate": ["what the host advocates for", "what the host supports most strongly"],
    "criticize": ["what the host criticizes", "what the host objects to most often"],
    "question": ["what the host questions", "what the host is skeptical about"],
    "discuss": ["recurring themes", "most discussed subjects"],
    "believe": ["core beliefs", "recurring assumptions"],
}
ASKING_PHRASES = ["please provide", "please share", "send me"]
SOURCE_TERMS = ["transcript", "source text", "source material", "podcast text", "material"]
DEFERRED_PHRASES = ["once shared", "once you share", "when you provide"]
AMBIGUOUS_SPEAKERS = ["unknown", "unclear", "ambiguous", "multiple", "mixed"]
# End of the fixed values.
