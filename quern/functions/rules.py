"""Word lists and patterns that the text operators take as parameters; these are their defaults."""

# fixed values: orthography rules, forbidden form -> correct form
FORBIDDEN = {
    "pathian": "pasian", "ram": "gam", "fapa": "tapa", "bawipa": "topa", "siangpahrang": "kumpipa",
    "cu": "tua", "cun": "tua", "suah": "chuak", "zalenna": "suahtakna", "nunnak": "nuntakna",
}
# fixed values: the forms that make a whole record unwanted
DENIED_FORMS = ["pathian", "fapa", "bawipa", "siangpahrang", "ram", "cu", "cun"]
# fixed values: function words of the target language
STOPWORDS = ["a", "ah", "ahin", "hi", "hin", "i", "in", "na", "nae", "nei", "ning", "ni", "nu", "nung", "pe", "pen", "pi", "pin", "po", "sak", "si", "sin", "su", "te", "thei", "ti", "tu", "tua", "un", "unga", "ungah", "vei", "veh", "vnge", "zong", "zonga"]
PARTICLES = ["a", "ah", "ahih", "amah", "an", "ang", "aw", "bang", "bawh", "cia", "ci", "cu", "cun", "ding", "hiam", "hi", "hoih", "in", "kip", "leh", "lo", "lu", "maw", "na", "naw", "ne", "ni", "pa", "pen", "pi", "sak", "si", "sung", "tawh", "te", "tui", "tua", "tu", "tun", "u", "uh", "un", "van", "va", "zong"]
VERB_ENDINGS = ["hi", "hiam", "kei", "lo", "ding", "sak", "nak", "ah", "hen", "leh", "pia", "nei", "ci", "thei", "bawl", "thu", "ciangin", "amah", "amaute"]
SUBJECT_MARKERS = ["ka", "na", "a", "i", "ki"]
NEGATIONS = ["kei", "lo", "si"]
TENSE_WORDS = ["ding", "sak", "nak", "ah", "hen", "lai"]
CONJUNCTIONS = ["leh", "hang", "cih"]
LANGUAGE_PATTERNS = ["hiam", "pasian", "topa", "vantung", "tui", "mi"]
ENGLISH_WORDS = ["the", "of", "and", "to", "in", "is", "was", "for", "with", "that", "on", "at", "by", "from", "were", "which", "their", "they", "there", "but", "not", "this", "as", "had", "it"]
ENGLISH_SUFFIXES = ["tion", "sion", "ness", "ment", "ing", "ous", "ful", "ly", "ed"]
GERMAN_WORDS = ["der", "die", "und", "das", "nicht", "ein", "eine", "ist"]
SUFFIXES = ["te", "in", "na", "ah", "pa", "nu", "un", "uh"]
PREFIXES = ["ki", "ka", "na", "a", "i"]
NOUN_SUFFIXES = ["na", "pi", "te", "pa", "nu"]
VERB_SUFFIXES = ["sak", "thei", "nak", "lo"]
BAD_DIALECTS = ["FCL", "HCL06"]
TOPICS = {"farm": ["maize", "rice", "goat", "goats", "farmers", "planting"], "school": ["school", "teacher", "teachers", "lesson", "lessons", "students"], "chapel": ["chapel", "prayer", "prayers", "hymn", "sermon"]}
# fixed values: word classes of the sentence checks
CLAUSE_SUBJECTS = ["ka", "na", "a", "i", "ki", "amah", "kasi", "nasi", "keimani", "nisu", "asuo", "isuo", "kisuo"]
CLAUSE_FINALS = ["hi", "hiam", "kei", "lo", "ding", "sak", "nak", "ah", "hen", "leh", "pia", "nei", "ci", "thei", "bawl", "thu", "ciangin", "amah", "amaute", "a", "in"]
CLAUSE_INNER = ["in", "uh", "tua", "na", "ah", "leh"]
CLAUSE_QUESTIONS = ["banghang", "bang_hang", "diam", "kua"]
CLAUSE_PARTICLES = [
    "a", "in", "hi", "hiam", "un", "ah", "leh", "tawh", "panin", "sungah", "tungah", "kiangah", "bangin", "hangin", "ciangin", "dingin", "khempeuh", "khat", "te", "ni", "na", "la",
    "la-in", "tu-in", "ni-in", "pai-in", "ma-in", "ci-in", "mai-ah", "lai-ah", "khua-ah", "kei", "lo", "ding", "sak", "nak", "hen", "pia", "nei", "ci", "thei", "bawl", "thu", "uh", "tua", "note",
]
# fixed values: words that need not be known, and suffixes that may follow a known stem
KNOWN_ANYWAY = sorted(set(CLAUSE_FINALS + CLAUSE_INNER + ["hiam", "hi", "un", "note", "tawh", "panin", "sungah", "tungah", "kiangah", "bangin", "hangin", "dingin", "khempeuh", "khat", "te", "ni", "la"]))
STEM_SUFFIXES = ["sak", "nak", "ah", "hen", "leh", "pia", "nei"]
# fixed values: the translation checks, name -> (pattern, whether it must be there)
TRANSLATION_RULES = {
    "has_ergative_in": (" in ", True), "has_agreement_ka": (r"(^|[^\w])ka\s+\w+", True), "has_agreement_na": (r"(^|[^\w])na\s+\w+", True), "has_agreement_a": (r"(^|[^\w])a\s+\w+", True),
    "has_agreement_i": (r"(^|[^\w])i\s+\w+", True), "has_agreement_eite": ("eite", True), "has_directional_hong": ("hong", True), "has_directional_va": ("va", True), "has_genitive_apostrophe": ("'", True),
    "has_imperative_in": (r" in\.$", True), "has_negation_kei": ("kei", True), "has_negation_kei_a_leh": ("kei a leh", True), "has_plural_uh": ("uh", True),
    "no_forbidden_words": ("(?i)pasian|tapa|topa|kumpipa|ram|tua", False), "no_uh_with_i": (r"uh.*(^|[^\w])i\s|(^|[^\w])i\s.*uh", False),
}
# fixed values: the canonical order of the books
BOOK_ORDER = ["GEN", "EXO", "LEV", "NUM", "DEU", "JOS", "JDG", "RUT", "1SA", "2SA", "1KI", "2KI", "1CH", "2CH", "EZR", "NEH", "EST", "JOB", "PSA", "PRO", "ECC", "SNG", "ISA", "JER", "LAM", "EZK", "DAN", "HOS", "JOL", "AMO", "OBA", "JON", "MIC", "NAM", "HAB", "ZEP", "HAG", "ZEC", "MAL", "MAT", "MRK", "LUK", "JHN", "ACT", "ROM", "1CO", "2CO", "GAL", "EPH", "PHP", "COL", "1TH", "2TH", "1TI", "2TI", "TIT", "PHM", "HEB", "JAS", "1PE", "2PE", "1JN", "2JN", "3JN", "JUD", "REV"]
#: a word's edges: neither letter nor digit on either side, whatever the regex engine's own notion
EDGE_LEFT, EDGE_RIGHT = r"(^|[^\p{L}\p{M}\p{N}_])", r"($|[^\p{L}\p{M}\p{N}_])"


def word_pattern(words: list[str]) -> str:
    """A case-blind pattern of whole words with explicit Unicode edges."""
    return f"(?i){EDGE_LEFT}({'|'.join(words)}){EDGE_RIGHT}"


def sql_list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def sql_array(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
