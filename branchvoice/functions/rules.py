"""Fixed values of the review rules.

Everything here must equal the specified tables for results to be right; the
order inside every list is the order in which rules are tried.
"""

from string import ascii_letters

# --- fixed values: text classes -------------------------------------------
# Arabic blocks kept by text cleaning and counted by language detection.
ARABIC_BLOCKS = (
    r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}"
    r"\x{FB50}-\x{FDCF}\x{FDF0}-\x{FDFF}\x{FE70}-\x{FEFF}"
)
FRENCH_LETTERS = ascii_letters + "àâäéèêëïîôöùûüÿçÀÂÄÉÈÊËÏÎÔÖÙÛÜŸÇ"

# --- fixed values: bank and city names (lower-cased text contains ...) ------
BANK_NAMES = [
    (("cih",), "CIH Bank"),
    (("attijariwafa",), "Attijariwafa Bank"),
    (("bmce",), "BMCE Bank"),
    (("barid",), "Al Barid Bank"),
    (("populaire",), "Banque Populaire"),
    (("agricole",), "Crédit Agricole du Maroc"),
    (("société générale",), "Société Générale Maroc"),
    (("bmci",), "BMCI"),
]
CITY_NAMES = [
    (("casa", "casablanca"), "Casablanca"),
    (("rabat",), "Rabat"),
    (("marrakech", "marrakesh"), "Marrakech"),
    (("tanger", "tangier"), "Tanger"),
    (("agadir",), "Agadir"),
    (("fès", "fes"), "Fès"),
]

# --- fixed values: sentiment words (lower-cased text contains ...) ----------
POSITIVE_WORDS = [
    "excellent", "formidable", "parfait", "superbe", "magnifique", "fantastique",
    "merveilleux", "génial", "top", "très bien", "bien", "bon", "bonne", "rapide",
    "efficace", "professionnel", "aimable", "courtois", "satisfait", "content",
    "recommande", "رائع", "ممتاز", "جيد", "سريع", "مهني", "راض", "أنصح",
]
NEGATIVE_WORDS = [
    "mauvais", "horrible", "nul", "catastrophique", "décevant", "lent", "inefficace",
    "impoli", "malpoli", "pas bien", "très mal", "mal", "problème", "souci", "attente",
    "queue", "retard", "fermé", "indisponible", "غير جيد", "سيء", "بطيء", "مشكلة",
    "انتظار", "مغلق",
]
# Star patterns, tried on the text as it is, after both word lists.
STAR_RULES = [
    ("5.*étoiles?|5/5", "Positif"),
    ("4.*étoiles?|4/5", "Positif"),
    ("[1-2].*étoiles?|[1-2]/5", "Negatif"),
]

# --- fixed values: bank dimension -------------------------------------------
BANK_ATTRIBUTES = [
    ("Attijariwafa Bank", "Banque Commerciale", 1904),
    ("BMCE Bank", "Banque Commerciale", 1959),
    ("Banque Populaire", "Banque Commerciale", 1961),
    ("CIH Bank", "Banque d'Investissement", 1920),
    ("Crédit Agricole du Maroc", "Banque d'Investissement", 1961),
    ("Al Barid Bank", "Banque Postale", 2009),
    ("Société Générale Maroc", "Banque Internationale", 1913),
    ("BMCI", "Banque Internationale", 1943),
]
OTHER_BANK_TYPE = "Autre"

# --- fixed values: branch dimension (lower-cased name contains ...) ---------
BRANCH_TYPES = [
    (("centre", "principal"), "Agence Principale"),
    (("mall", "centre commercial"), "Agence Centre Commercial"),
    (("aéroport", "airport"), "Agence Aéroport"),
    (("université", "campus"), "Agence Universitaire"),
]
STANDARD_BRANCH_TYPE = "Agence Standard"
BRANCH_SERVICES = [
    (("centre", "principal"), "Services complets, Conseillers, Coffres-forts"),
    (("mall", "centre commercial"), "Services de base, Distributeurs, Guichets"),
    (("aéroport", "airport"), "Change, Carte de crédit, Services voyage"),
]
STANDARD_SERVICES = "Services standards"

# --- fixed values: location dimension ---------------------------------------
CITY_REGIONS = [
    (("Casablanca", "Rabat", "Salé"), "Grand Casablanca-Settat"),
    (("Marrakech", "Agadir"), "Marrakech-Safi"),
    (("Tanger", "Tétouan"), "Tanger-Tétouan-Al Hoceima"),
    (("Fès", "Meknès"), "Fès-Meknès"),
    (("Oujda",), "Oriental"),
    (("Laâyoune",), "Laâyoune-Sakia El Hamra"),
]
OTHER_REGION = "Autre Région"
CITY_CENTRES = [
    ("Casablanca", "33.5731,-7.5898"),
    ("Rabat", "34.0209,-6.8416"),
    ("Marrakech", "31.6295,-7.9811"),
    ("Tanger", "35.7595,-5.8340"),
    ("Agadir", "30.4278,-9.5981"),
    ("Fès", "34.0181,-5.0078"),
    ("Meknès", "33.8935,-5.5473"),
    ("Oujda", "34.6867,-1.9114"),
]
CITY_SIZES = [
    (("Casablanca", "Rabat", "Marrakech"), "Grande Ville"),
    (("Tanger", "Agadir", "Fès"), "Ville Moyenne"),
]
SMALL_CITY = "Petite Ville"

# --- fixed values: sentiment dimension --------------------------------------
SENTIMENTS = [
    (1, "Positif", "4.0-5.0", "Avis positifs et satisfaisants"),
    (2, "Neutre", "2.5-3.9", "Avis neutres ou mitigés"),
    (3, "Negatif", "0.0-2.4", "Avis négatifs et mécontents"),
]

# --- fixed values: topic dimension (case-sensitive contains) ----------------
DEFAULT_TOPIC = "Expérience générale"
TOPIC_CATEGORIES = [
    (("Service",), "Expérience Client"),
    (("bancaire",), "Produits & Services"),
    (("attente",), "Opérations"),
    (("Horaire",), "Accessibilité"),
    (("Tarif",), "Prix & Frais"),
    (("Accessibilité",), "Infrastructure"),
]
OTHER_TOPIC_CATEGORY = "Général"
TOPIC_DESCRIPTIONS = [
    ("Service Client", "Qualité de l'accueil et du service"),
    ("Services bancaires", "Produits et services bancaires"),
    ("Temps d'attente", "Durée d'attente et files"),
    ("Horaires", "Heures d'ouverture et disponibilité"),
    ("Tarifs", "Prix et frais bancaires"),
    ("Accessibilité", "Facilité d'accès et transport"),
    ("Expérience générale", "Impression générale de l'expérience"),
]

# --- fixed values: topic keywords (substring of a term) ---------------------
TOPIC_KEYWORDS = [
    (("attent", "file", "rapid", "lent"), "Temps d'attente"),
    (("accueil", "personnel", "conseil", "servic"), "Service client"),
    (("cart", "compt", "retrait", "depot"), "Services bancaires"),
    (("horair", "ouvert", "ferm"), "Horaires"),
    (("parking", "proch", "transport"), "Accessibilité"),
    (("prix", "frais", "cout"), "Tarifs"),
    (("secur", "confianc"), "Sécurité"),
]

# Accented letters and what they are without.
FOLDED = ("àâäéèêëîïôöùûüç", "aaaeeeeiioouuuc")

# --- fixed values: stop words ------------------------------------------------
DOMAIN_STOP_WORDS = {
    "fr": [
        "banque", "agence", "bank", "cih", "bmce", "attijariwafa", "barid", "très",
        "tout", "bien", "mal", "plus", "moins", "aussi", "encore", "toujours",
        "jamais", "ici", "là", "maintenant", "aujourd", "hier",
    ],
    "ar": ["بنك", "وكالة", "فرع", "جدا", "كل", "هذا", "ذلك", "هنا", "هناك"],
}
# Arabic function words; the French ones come from Spark's own list.
FUNCTION_WORDS = {
    "ar": [
        "على", "إلى", "عن", "مع", "هذه", "التي", "الذي", "الذين", "كان", "كانت",
        "لكن", "حتى", "بعد", "قبل", "عند", "كما", "ليس", "هو", "هي", "هم", "نحن",
        "أنت", "أنا", "ما", "لا", "لم", "لن", "قد", "إن", "أن", "أو", "ثم", "بين",
        "غير", "بعض", "أيضا", "منذ", "حيث", "إذا", "كيف", "متى", "أين", "لماذا",
    ],
}

# French vowels, and the regions of a word, as patterns of the stem that must be left in front of an
# ending: it lies in the first region behind a vowel and the next consonant, in the second one behind
# such a pair of that region again, in the verb region behind the first three letters (two
# vowels first) or the first vowel after the first letter.
STEM_VOWELS = "aeiouyâàëéêèïîôûùœ"
STEM_REGIONS = {
    "any": r"\p{L}{2}\p{L}*?",
    "plural": r"\p{L}{2}\p{L}*?[^aiouès]",
    "first": rf"[^{STEM_VOWELS}]*[{STEM_VOWELS}]+[^{STEM_VOWELS}]\p{{L}}*?",
    "second": rf"[^{STEM_VOWELS}]*[{STEM_VOWELS}]+[^{STEM_VOWELS}]+[{STEM_VOWELS}]+[^{STEM_VOWELS}]\p{{L}}*?",
    "verb": rf"(?:[{STEM_VOWELS}]{{2}}\p{{L}}|\p{{L}}[^{STEM_VOWELS}]*[{STEM_VOWELS}])\p{{L}}*?",
}
# Rounds of endings by region, with what takes their place. In a round the first rule that fits is the only one.
STEM_ROUNDS = {
    "fr": [
        [("plural", "s", "")],
        [
            ("second", "ances?|iques?|ismes?|ables?|ibles?|istes?|eux|atrices?|ateurs?|ations?|ités?|ifs?|ives?", ""),
            ("second", "logies?", "log"),
            ("second", "usions?|utions?", "u"),
            ("second", "ences?", "ent"),
            ("first", "issements?", ""),
            ("verb", "amments?", "ant"),
            ("verb", "emments?", "ent"),
            ("verb", "ements?", ""),
            ("first", "euses?", "eux"),
            ("first", "eaux", "eau"),
            ("first", "aux", "al"),
            ("second", "ions?", ""),
            ("verb", "eraient|erions|erait|erais|eront|erons|aient|èrent|erai|eras|erez|i?ères?|antes?|ants?|ait|ais|iez|ées?|era|ier|és?|er|ez", ""),
            ("verb", "issaient|issantes?|issants?|issent|issait|irait|irent|iront|ites?|ies?|ira|is|it|ir|i", ""),
        ],
        [("any", "es|s|e", "")],
        [("any", "nn", "n"), ("any", "tt", "t"), ("any", "ll", "l")],
    ],
    # Conjunction, preposition and article in front, then pronouns and number or gender at the end.
    "ar": [
        [("front", "و?(?:ال|بال|كال|فال)|لل|و", "")],
        [("long", "هما|كما|ها|هم|هن|نا|كم", "")],
        [("long", "ات|ون|ين|ان|ية", "")],
        [("long", "ة|ه|ي", "")],
    ],
}
# Letters that stay where an Arabic prefix or ending goes.
STEM_REGIONS["long"] = r"\p{L}{3}\p{L}*?"
STEM_REGIONS["front"] = r"\p{L}{3}\p{L}*"

# --- fixed values: ratings, quality and bins -----------------------------------
# \z, not $: on the JVM $ also matches before a final line break.
RATING = r"^[0-5](\.[0-9])?\z"
# Least length and whether the language must be known, with the score.
TEXT_QUALITY = [(20, True, 1.0), (10, True, 0.8), (5, False, 0.6)]
LOW_QUALITY = 0.3
# Longest text of each bin.
LENGTH_BINS = [(10, "tres_court"), (50, "court"), (150, "moyen"), (300, "long")]
LONGEST_BIN = "tres_long"
# Least rating of each bin.
RATING_BINS = [(4, "Excellent"), (3, "Bon"), (2, "Moyen"), (1, "Mauvais")]
UNRATED = "Non noté"

# --- fixed values: dates ---------------------------------------------------------
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
DMY_SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}\z"
DMY_DASH_DATE = r"\d{1,2}-\d{1,2}-\d{4}"
UNKNOWN_DATE = "Date inconnue"
# Relative dates: pattern in lower-cased text, and how far back, in days or months.
RELATIVE_DATES = [
    ("(?s)il y a.*jour", "days", 1), ("(?s)il y a.*semaine", "days", 7), ("(?s)il y a.*mois", "months", 1),
]

# --- fixed values: crawl lists -----------------------------------------------
CRAWLED_BANKS = [
    "CIH Bank", "Attijariwafa Bank", "BMCE Bank", "Banque Populaire", "BMCI",
    "Crédit Agricole du Maroc", "Société Générale Maroc", "Banque Centrale Populaire",
    "Bank of Africa", "Al Barid Bank", "Crédit du Maroc", "Bank Al-Maghrib",
    "Bank Assafa", "Umnia Bank",
]
CRAWLED_CITIES = [
    "Casablanca", "Rabat", "Marrakech", "Fès", "Tanger", "Agadir", "Oujda", "Meknès",
    "Tétouan", "Kenitra", "Safi", "El Jadida", "Beni Mellal", "Errachidia", "Nador",
    "Settat", "Larache", "Khouribga", "Guelmim", "Laâyoune", "Dakhla", "Ouarzazate",
    "Mohammedia", "Taza", "Taourirt", "Ksar El Kebir", "Berkane", "Sidi Bennour",
    "Essaouira", "Taroudant", "Tiznit", "Azilal",
]
PAGE_DEFAULTS = {"nom": "Nom inconnu", "localisation": "Localisation inconnue", "note": "0"}

# Text tokens that the CSV load treats as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: accepted banks of the archived data test ------------------
ACCEPTED_BANKS = [name for _, name in BANK_NAMES]

# --- fixed values: report labels ----------------------------------------------
# No generator exists for these three labels; the cut points are our own and agree
# with every row of the published reports.
PERFORMANCE_LEVELS = [(4.0, "Excellente"), (3.0, "Bonne"), (2.0, "Moyenne")]
LOW_PERFORMANCE = "Faible"
DOMINANT_SHARE = 70.0
POPULARITY_LEVELS = [(50.0, "Très Populaire"), (10.0, "Populaire")]
LOW_POPULARITY = "Faible"
