"""Rules on hand-made rows."""

from branchvoice.functions import names, text


def test_clean_text(apply):
    cases = {
        "https://x.example/a?b=1": "",
        "Voir https://x.example/a?b=1 MERCI!!": "voir merci",
        "Très  déçu\n\nde l'agence...": "très déçu de l'agence",
        "bon 👍 service": "bon service",
        "a b\tc": "a b c",
        "خدمة، ممتازة؟": "خدمة، ممتازة؟",
        "under_score & co": "under_score co",
        "": "",
    }
    assert apply(text.clean_text, list(cases)) == list(cases.values())


def test_normalize_equals_clean_and_clean_is_idempotent(apply):
    samples = ["A.. b!! c??", "Ça va... très bien!!!", "x  ؟؟ y", "http://a.b c"]
    cleaned = apply(text.clean_text, samples)
    assert apply(text.normalize_text, samples) == cleaned
    assert apply(text.clean_text, cleaned) == cleaned


def test_detect_language_bounds(apply):
    cases = {
        "ششش1234567": "mixed",  # exactly 30 % Arabic, no Latin
        "شششش123456": "ar",
        "abcde12345": "mixed",  # exactly 50 % Latin
        "abcdef1234": "fr",
        "ششششabcdef": "ar",
        "12345": "mixed",
        "": "mixed",
        "éàçùï": "fr",
    }
    assert apply(text.detect_language, list(cases)) == list(cases.values())


def test_detect_arabic_any(apply):
    assert apply(text.detect_arabic_any, ["bon", "bon جدا"]) == ["Français", "Arabe"]


def test_sentiment_first_match(apply):
    cases = {
        "service inefficace": "Positif",
        "pas bien": "Positif",
        "غير جيد": "Positif",
        "abonné depuis": "Positif",
        "attente longue": "Negatif",
        "accueil malpoli": "Negatif",
        "donne 5 étoiles": "Positif",
        "5\nétoiles": "Positif",
        "4 sur\nétoile": "Positif",
        "2 étoiles": "Negatif",
        "je mets 1/5": "Negatif",
        "je mets 3/5": "Neutre",
        "guichet": "Neutre",
    }
    assert apply(text.analyze_sentiment, list(cases)) == list(cases.values())


def test_missing_values(apply):
    values = [None, "", "  ", "nan", " null ", " x "]
    assert apply(lambda c: text.handle_missing(c, "?"), values) == ["?", "?", "?", "?", "?", " x "]
    assert apply(lambda c: text.blank_to(c, "?"), values) == ["?", "?", "?", "nan", "null", "x"]


def test_bank_and_city_rules(apply):
    banks = {
        "CIH": "CIH Bank",
        "Attijariwafa bank agence": "Attijariwafa Bank",
        "BMCE groupe populaire": "BMCE Bank",
        "al barid": "Al Barid Bank",
        "Banque Centrale Populaire": "Banque Populaire",
        "CREDIT AGRICOLE": "Crédit Agricole du Maroc",
        "Société Générale": "Société Générale Maroc",
        "bmci x": "BMCI",
        "Umnia Bank": "Umnia Bank",
    }
    assert apply(names.normalize_bank, list(banks)) == list(banks.values())
    cities = {"casa": "Casablanca", "RABAT": "Rabat", "Marrakesh": "Marrakech", "tangier": "Tanger",
              "Agadir": "Agadir", "fes": "Fès", "Fès": "Fès", "Safi": "Safi"}
    assert apply(names.normalize_city, list(cities)) == list(cities.values())


def test_branch_rules(apply):
    assert apply(names.branch_type, ["Centre commercial", "City Mall", "Airport", "Campus", "x"]) == [
        "Agence Principale", "Agence Centre Commercial", "Agence Aéroport", "Agence Universitaire", "Agence Standard"]
    assert apply(names.branch_services, ["Campus", "Mall"]) == [
        "Services standards", "Services de base, Distributeurs, Guichets"]


def test_dimension_attributes(apply):
    assert apply(names.bank_type, ["BMCI", "Umnia Bank"]) == ["Banque Internationale", "Autre"]
    assert apply(names.founded_year, ["BMCI", "Umnia Bank"]) == [1943, None]
    assert apply(names.city_region, ["Salé", "Safi"]) == ["Grand Casablanca-Settat", "Autre Région"]
    assert apply(names.city_centre, ["Oujda", "Safi"]) == ["34.6867,-1.9114", None]
    assert apply(names.city_size, ["Fès", "Safi"]) == ["Ville Moyenne", "Petite Ville"]
    # Case decides: 'Service client' is not 'Service Client'.
    assert apply(names.topic_description, ["Service Client", "Service client"]) == [
        "Qualité de l'accueil et du service", "Service client"]
    assert apply(names.topic_category, ["Services bancaires", "Temps d'attente", "Temps d'Attente", "Sécurité"]) == [
        "Expérience Client", "Opérations", "Général", "Général"]


def test_topic_words(apply):
    assert apply(text.prep_text, ["L'accueil, 3 fois: nul!"]) == ["l accueil fois nul"]
    words = apply(lambda c: text.topic_words(c, "fr"), ["La banque: accueils très rapides, 24h et conseillère_x"])[0]
    assert words == ["accueil", "rapid"]
    assert apply(lambda c: text.topic_words(c, "ar"), ["بنك خدمات سريعة"])[0] == ["خدم", "سريع"]
    assert apply(names.keyword_topic, ["frais carte", "zzz"]) == ["Services bancaires", None]
