"""Small lexicons and gazetteers for the words the driver's invented corpora use.

Real use passes the full published tables; these have the same shape. Fixed values.
"""

# (word, valence in -4..4)
VALENCES = [
    ("scum", -3.0), ("idiot", -2.6), ("trash", -2.0), ("worthless", -2.2), ("moron", -2.4), ("pathetic", -2.3),
    ("loser", -2.4), ("stupid", -2.4), ("disgusting", -2.9), ("clown", -1.2), ("los", -0.9), ("sich", -0.4),
    ("er", -0.3), ("un", -0.6), ("das", -0.2), ("ther", 0.9), ("thon", 1.4), ("heit", 1.7), ("elle", 1.2),
    ("erin", 2.1), ("keit", 1.5), ("lich", 0.8), ("tre", 0.7), ("dans", 0.5), ("pour", 0.6), ("thing", 1.3),
    ("ble", 1.9), ("rewh", 2.4), ("ment", 0.3), ("tion", 1.1), ("thsh", -1.6), ("erst", -1.8), ("hehely", -1.1),
]

# (word, polarity in -1..1, subjectivity in 0..1)
POLARITIES = [
    ("scum", -0.9, 0.9), ("idiot", -0.8, 0.8), ("trash", -0.6, 0.7), ("worthless", -0.8, 0.9), ("moron", -0.8, 1.0),
    ("pathetic", -1.0, 1.0), ("loser", -0.7, 0.8), ("stupid", -0.8, 1.0), ("disgusting", -1.0, 1.0),
    ("clown", -0.3, 0.4), ("los", -0.2, 0.1), ("sich", -0.1, 0.2), ("er", -0.15, 0.3), ("un", -0.25, 0.2),
    ("das", -0.05, 0.0), ("ther", 0.3, 0.4), ("thon", 0.45, 0.6), ("heit", 0.5, 0.5), ("elle", 0.35, 0.7),
    ("erin", 0.65, 0.75), ("keit", 0.4, 0.55), ("lich", 0.2, 0.3), ("tre", 0.15, 0.35), ("dans", 0.1, 0.1),
    ("pour", 0.2, 0.25), ("thing", 0.4, 0.5), ("ble", 0.6, 0.9), ("rewh", 0.7, 0.8), ("ment", 0.1, 0.2),
    ("tion", 0.3, 0.6), ("thsh", -0.4, 0.6), ("erst", -0.5, 0.5), ("hehely", -0.3, 0.4),
]

# (word, emotion)
EMOTION_WORDS = [
    ("ble", "joy"), ("rewh", "joy"), ("thon", "trust"), ("keit", "trust"), ("heit", "trust"), ("ther", "anticipation"),
    ("thing", "anticipation"), ("ble", "anticipation"), ("thsh", "surprise"), ("los", "sadness"), ("pathetic", "sadness"),
    ("un", "fear"), ("erst", "fear"), ("idiot", "anger"), ("stupid", "anger"), ("scum", "anger"), ("scum", "disgust"),
    ("disgusting", "disgust"), ("trash", "disgust"), ("moron", "anger"),
]

# (phrase, label, score)
GAZETTEER = [
    ("of the", "ORG", 0.9), ("to the", "GPE", 0.8), ("the of", "PERSON", 0.7), ("of the of", "WORK_OF_ART", 0.95),
    ("rewh", "PRODUCT", 0.6), ("thatin", "PERSON", 0.85), ("ononst", "LOC", 0.75), ("hehely", "EVENT", 0.9),
    ("orantion", "NORP", 0.5), ("de la", "GPE", 0.9), ("de", "CARDINAL", 0.9), ("der die", "ORG", 0.66),
    ("the idiot", "PERSON", 0.4), ("scum", "NORP", 0.55), ("inoran", "PRODUCT", 0.3), ("and the", "DATE", 0.8),
]

# (phrase, label, score) for caller-given labels
DOMAIN_GAZETTEER = [
    ("of the", "game feature", 0.9), ("rewh", "platform", 0.6), ("thatin", "character name", 0.85),
    ("ononst", "company/studio", 0.41), ("hehely", "release date", 0.4), ("inoran", "price", 0.3),
    ("orantion", "platform", 0.39), ("de la", "character name", 0.55), ("der die", "price", 0.7), ("und", "verb", 0.9),
]

# (term)
ASPECTS = [
    ("the",), ("der",), ("la",), ("que",), ("rewh",), ("and",), ("und",), ("for",), ("with",), ("thatin",), ("orre",),
]

# Syllables standing in for category names in the routing query.
ROUTE_CATEGORIES = ["sentiment", "summary", "topics", "keit", "tion", "eau", "qa"]

# Words expected in the answers of the first-comment questions.
EXPECTED_WORDS = ["rewh", "thatin", "keit", "heit", "eaux", "worthless"]
