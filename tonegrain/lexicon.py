"""Word lists, domain keywords, entity patterns and stopwords used for scoring.

A :class:`Lexicon` is a plain value object.  Pass your own to any scoring
function to replace the default lists; nothing else in the package needs to
change, because every expression is built from the object it is given.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --------------------------------------------------------------------------
# Fixed values.  Results depend on every one of them, so they are stated as they
# are, in the order in which they are given.
# --------------------------------------------------------------------------
POSITIVE: dict[str, float] = {
    "good": 1, "great": 2, "excellent": 2, "outstanding": 3, "superb": 3, "wonderful": 2, "fantastic": 2, "amazing": 2,
    "awesome": 2, "brilliant": 2, "perfect": 3, "best": 2, "better": 1, "superior": 2, "exceptional": 3, "happy": 2,
    "joy": 2, "joyful": 2, "pleased": 1, "delighted": 2, "satisfied": 1, "impressed": 1, "love": 2, "like": 1,
    "enjoy": 1, "appreciate": 1, "grateful": 2, "thankful": 1, "blessed": 2, "positive": 1, "optimistic": 1, "hopeful": 1,
    "confident": 1, "successful": 2, "success": 2, "achieve": 1, "win": 2, "winner": 2, "innovative": 1, "creative": 1,
    "efficient": 1, "effective": 1, "reliable": 1, "trustworthy": 1, "honest": 1, "fair": 1, "helpful": 1, "supportive": 1,
    "friendly": 1, "kind": 1, "generous": 2, "strong": 1, "powerful": 1, "capable": 1, "skilled": 1, "expert": 1,
    "fast": 1, "quick": 1, "easy": 1, "simple": 1, "smooth": 1, "clean": 1, "clear": 1, "accurate": 1, "precise": 1,
    "profit": 1, "growth": 1, "improve": 1, "improvement": 1, "benefit": 1, "advantage": 1, "opportunity": 1,
    "progress": 1, "safe": 1, "secure": 1, "stable": 1, "healthy": 1,
}

NEGATIVE: dict[str, float] = {
    "bad": 1, "terrible": 2, "horrible": 2, "awful": 2, "dreadful": 2, "poor": 1, "worst": 3, "worse": 1, "inferior": 2,
    "disappointing": 2, "sad": 1, "unhappy": 1, "miserable": 2, "depressed": 2, "upset": 1, "angry": 2, "frustrated": 1,
    "annoyed": 1, "furious": 3, "rage": 3, "hate": 2, "dislike": 1, "despise": 2, "loathe": 3, "failure": 2, "fail": 1,
    "failed": 1, "lose": 1, "lost": 1, "loser": 2, "wrong": 1, "incorrect": 1, "inaccurate": 1, "false": 1, "lie": 2,
    "problem": 1, "issue": 1, "error": 1, "bug": 1, "fault": 1, "mistake": 1, "slow": 1, "difficult": 1, "hard": 1,
    "complicated": 1, "confusing": 1, "broken": 2, "damage": 2, "damaged": 2, "destroy": 3, "destroyed": 3, "danger": 2,
    "dangerous": 2, "harmful": 2, "toxic": 2, "risk": 1, "expensive": 1, "costly": 1, "overpriced": 2, "waste": 1,
    "wasteful": 1, "inefficient": 1, "useless": 2, "corrupt": 2, "dishonest": 2, "fraud": 3, "scam": 3, "fake": 2,
    "violent": 2, "abuse": 3, "abusive": 3, "harassment": 3, "sick": 1, "ill": 1, "disease": 2, "pain": 1, "suffer": 2,
    "suffering": 2, "loss": 1, "deficit": 1, "decline": 1, "decrease": 1, "drop": 1, "concern": 1, "worried": 1,
    "anxiety": 1, "fear": 1, "scared": 1, "ugly": 2, "dirty": 1, "messy": 1, "chaotic": 2, "boring": 1, "tedious": 1,
    "monotonous": 1, "dull": 1, "weak": 1, "fragile": 1, "unstable": 1,
}

INTENSIFIERS: dict[str, float] = {
    "very": 1.5, "extremely": 2.0, "incredibly": 2.0, "absolutely": 2.0, "totally": 1.5, "completely": 1.5, "utterly": 2.0,
    "highly": 1.5, "really": 1.3, "super": 1.5, "so": 1.2, "quite": 1.1, "deeply": 1.5, "strongly": 1.5, "remarkably": 1.5,
    "exceptionally": 2.0,
}

# Those of two words are told apart by their space.
DIMINISHERS: dict[str, float] = {
    "somewhat": 0.6, "slightly": 0.5, "a bit": 0.6, "a little": 0.5, "kind of": 0.5, "sort of": 0.5, "rather": 0.7,
    "fairly": 0.7, "barely": 0.3, "hardly": 0.3, "scarcely": 0.3,
}

NEGATIONS = (
    "not", "no", "never", "neither", "nor", "none", "nobody", "nothing", "nowhere", "isn't", "aren't", "wasn't", "weren't",
    "don't", "doesn't", "didn't", "won't", "wouldn't", "can't", "cannot", "couldn't", "shouldn't", "without", "lack",
    "lacking",
)

DOMAIN_KEYWORDS: dict[str, tuple[str, ...]] = {
    "technology": (
        "software", "hardware", "algorithm", "database", "server", "cloud", "api", "machine learning", "ai", "data",
        "network", "security", "code", "programming", "developer", "app", "application",
    ),
    "finance": (
        "revenue", "profit", "loss", "market", "stock", "investment", "budget", "cost", "price", "financial", "economy",
        "bank", "fund", "asset", "debt", "growth", "gdp",
    ),
    "health": (
        "patient", "hospital", "doctor", "medicine", "treatment", "disease", "health", "clinical", "drug", "symptom",
        "diagnosis", "surgery", "vaccine", "therapy", "mental health", "wellness",
    ),
    "education": (
        "student", "teacher", "school", "university", "learning", "course", "research", "study", "academic", "curriculum",
        "degree",
    ),
    "social": (
        "community", "society", "people", "culture", "diversity", "inclusion", "human rights", "social", "welfare",
    ),
    "environment": (
        "climate", "pollution", "energy", "renewable", "carbon", "sustainability", "environment", "ecology", "nature",
    ),
}

# Case is ignored for all of them.
PATTERNS: dict[str, str] = {
    "email": r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b",
    "url": r"https?://[^\s]+",
    "phone": r"\b(?:\+?\d[\d\-\s().]{7,14}\d)\b",
    "date": r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
    "currency": r"\$[\d,]+(?:\.\d{2})?|\b\d+(?:\.\d{2})?\s*(?:USD|EUR|GBP|INR)\b",
    "percentage": r"\b\d+(?:\.\d+)?%",
    "hashtag": r"#\w+",
    "mention": r"@\w+",
    "number": r"\b\d+(?:,\d{3})*(?:\.\d+)?\b",
    "question": r"\?",
    "exclamation": r"!",
    "all_caps_word": r"\b[A-Z]{2,}\b",
}

STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "do", "does", "did", "will", "would", "shall", "should", "may", "might", "must",
    "can", "could", "this", "that", "these", "those", "it", "its", "from", "as", "by", "not", "so", "if", "then", "than",
    "when", "where", "who", "which", "what", "how", "all", "any", "each", "no", "nor", "yet", "both", "either", "neither",
    "one", "two", "three", "also", "just", "more", "other", "some", "such", "up", "out", "into",
)

# Chunk sizes by line count of the file: lines below the bound -> lines per chunk.
CHUNK_SIZES: tuple[tuple[int, int], ...] = ((500, 10), (5_000, 50), (50_000, 200), (500_000, 500))
LARGEST_CHUNK_SIZE = 1_000

POSITIVE_THRESHOLD = 0.15      # label is "positive" above it, "negative" below its negative
NEGATION_WINDOW = 3            # tokens looked back for a negation
PREVIEW_CHARS = 5_000          # code points of chunk text that a preview shows
# --------------------------------------------------------------------------


def _weights(words: dict[str, float], n_words: int = 1) -> dict[str, float]:
    return {word: float(weight) for word, weight in words.items() if word.count(" ") == n_words - 1}


@dataclass(frozen=True)
class Lexicon:
    """Everything the scorer looks words up in.  All words are lower case.

    ``patterns`` are Java regular expressions, found whatever the case; the default ones run
    in a faster form that finds the same texts.
    """

    positive: dict[str, float] = field(default_factory=lambda: _weights(POSITIVE))
    negative: dict[str, float] = field(default_factory=lambda: _weights(NEGATIVE))
    intensifiers: dict[str, float] = field(default_factory=lambda: _weights(INTENSIFIERS))
    diminishers: dict[str, float] = field(default_factory=lambda: _weights(DIMINISHERS))
    two_word_diminishers: dict[str, float] = field(default_factory=lambda: _weights(DIMINISHERS, 2))
    negations: frozenset[str] = field(default_factory=lambda: frozenset(NEGATIONS))
    domains: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(DOMAIN_KEYWORDS))
    patterns: dict[str, str] = field(default_factory=lambda: dict(PATTERNS))
    stopwords: frozenset[str] = field(default_factory=lambda: frozenset(STOPWORDS))

    @property
    def sentiment(self) -> dict[str, float]:
        """Signed weight per sentiment word; a word in both lists counts as positive."""
        return {**{w: -v for w, v in self.negative.items()}, **self.positive}

    @property
    def modifiers(self) -> dict[str, float]:
        """Weight per one-word modifier; an intensifier wins over a diminisher."""
        return {**self.diminishers, **self.intensifiers}

    @property
    def two_word_starters(self) -> frozenset[str]:
        return frozenset(pair.split(" ")[0] for pair in self.two_word_diminishers)

    @property
    def active_words(self) -> frozenset[str]:
        """Every token that can change the outcome of scoring."""
        return (
            frozenset(self.sentiment) | frozenset(self.modifiers)
            | self.negations | self.two_word_starters
        )

    def with_(self, **changes) -> "Lexicon":
        return replace(self, **changes)


DEFAULT_LEXICON = Lexicon()
