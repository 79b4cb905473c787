"""Fixed values that results depend on: word lists, lookup tables and identifiers."""

# Namespaces of the version-5 UUIDs, one per kind of entity.
NAMESPACES = {
    "recipe": "0c5fdcc3-d2b2-5fe9-be6f-9a8139c43683",
    "category": "de548484-9caf-57a1-9d70-f64026d222e2",
    "tag": "31259936-af1f-5919-b815-1e9abe9eab5a",
    "ingredient": "a2f08e63-732f-5f1c-b76c-5558c1aab3b8",
}

# Fraction characters and their plain text.
FRACTIONS = {
    "¼": "1/4", "½": "1/2", "¾": "3/4", "⅐": "1/7", "⅑": "1/9", "⅒": "1/10", "⅓": "1/3", "⅔": "2/3", "⅕": "1/5", "⅖": "2/5",
    "⅗": "3/5", "⅘": "4/5", "⅙": "1/6", "⅚": "5/6", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8",
}

# Units known when a catalog is built; pages are parsed without pack and packs.
UNITS = (
    "can", "cans", "clove", "cloves", "cup", "cups", "gram", "grams", "g", "kg", "kilogram", "kilograms", "lb", "lbs", "ounce", "ounces",
    "oz", "package", "packages", "pack", "packs", "piece", "pieces", "pinch", "pinches", "pound", "pounds", "sprig", "sprigs", "tablespoon", "tablespoons", "tbsp",
    "teaspoon", "teaspoons", "tsp",
)
PAGE_UNITS = (
    "can", "cans", "clove", "cloves", "cup", "cups", "gram", "grams", "g", "kg", "kilogram", "kilograms", "lb", "lbs", "ounce", "ounces",
    "oz", "package", "packages", "piece", "pieces", "pinch", "pinches", "pound", "pounds", "sprig", "sprigs", "tablespoon", "tablespoons", "tbsp", "teaspoon", "teaspoons",
    "tsp",
)

# Phrases of an amount before a name, tried in this order.
AMOUNT_PHRASES = (
    "a bit of ", "a bunch of ", "a dash of ", "a few dashes of ", "a few drops of ", "a hint of ", "a pack of ", "a pinch of ",
    "an assortment of ", "a slice of ", "a can of ", "can of ", "pack of ", "bunch of ", "head of ",
)

# Words that are dropped before a name, and words that are dropped anywhere.
LEADING_WORDS = (
    "additional", "another", "bit", "bunch", "dash", "few", "fresh", "head", "heads", "hint", "large", "medium", "piece", "pieces", "pack", "raw",
    "small", "thumb", "thumbs", "whole",
)
DROPPED_WORDS = (
    "also", "around", "best", "length", "optional",
)

# Words that tell of a preparation, when a document is repaired and when a catalog is built.
PREPARATIONS = (
    "beaten", "boiled", "butterflied", "butterfly", "chopped", "cleaned", "cracked", "crushed", "cubed", "cut", "deboned", "deveined", "diced", "drained", "filleted", "grated",
    "ground", "gutted", "halved", "knotted", "mashed", "minced", "peeled", "pitted", "quartered", "removed", "scaled", "scales", "seeded", "shelled", "shredded", "sliced",
    "soaked", "softened", "trimmed", "wedged",
)
BUILD_PREPARATIONS = (
    "beaten", "boiled", "butterflied", "butterfly", "chopped", "cleaned", "cracked", "crushed", "cubed", "cut", "deboned", "deveined", "diced", "drained", "filleted", "grated",
    "ground", "gutted", "halved", "knotted", "mashed", "minced", "peeled", "pitted", "quartered", "removed", "scaled", "scales", "seeded", "shelled", "shredded", "sliced",
    "soaked", "softened", "trimmed", "wedged", "head", "heads",
)

# Verbs that begin a trailing preparation; repair doesn't know knotted.
TAIL_VERBS = (
    "cut into", "cut in", "cut to", "chopped", "cleaned", "cubed", "diced", "gutted", "julienned", "knotted", "minced", "peeled", "pitted", "quartered", "scaled", "seeded",
    "shelled", "shredded", "sliced", "trimmed", "wedged",
)
REPAIR_TAIL_VERBS = (
    "cut into", "cut in", "cut to", "chopped", "cleaned", "cubed", "diced", "gutted", "julienned", "minced", "peeled", "pitted", "quartered", "scaled", "seeded", "shelled",
    "shredded", "sliced", "trimmed", "wedged",
)

# Compounds that may be split, with their parts.
COMPOUNDS = {
    "fish sauce and crushed peppercorn": ("fish sauce", "crushed peppercorn"),
    "fish sauce and ground black pepper": ("fish sauce", "ground black pepper"),
    "fish sauce and ground white pepper": ("fish sauce", "ground white pepper"),
    "salt and ground black pepper": ("salt", "ground black pepper"),
    "salt and pepper": ("salt", "pepper"),
}

# Patterns of what is no ingredient.
EXCLUDED = ("^aluminum foil$", "^a double boiler$", "^bamboo skewers(?: .*)?$", r"^water for boiling\b", r"^additional water for boiling\b")

# Irregular plurals.
IRREGULAR = {"batches": "batch", "berries": "berry", "chilies": "chili", "eggs": "egg", "leaves": "leaf", "loaves": "loaf", "potatoes": "potato", "tomatoes": "tomato"}

# Names after which a unit is inferred, tried in this order.
UNIT_HINTS = (
    ("garlic", "clove"), ("fennel bulb", "bulb"), ("bulb", "bulb"), ("head", "head"), ("cabbage", "head"), ("lettuce", "head"),
    ("stalk", "stalk"), ("lemongrass", "stalk"), ("celery", "stalk"), ("bay leaf", "piece"), ("star anise", "piece"),
)

# Difficulty as pages and as repaired documents name it.
PAGE_DIFFICULTY = {
    "easy": "easy", "medium": "medium", "hard": "hard", "expert": "expert", "beginner": "easy", "simple": "easy", "quick": "easy", "intermediate": "medium",
    "moderate": "medium", "advanced": "hard", "challenging": "hard", "professional": "expert", "complex": "expert",
}
REPAIR_DIFFICULTY = {"beginner": "easy", "easy": "easy", "intermediate": "medium", "medium": "medium", "advanced": "hard", "hard": "hard", "expert": "expert"}

# Recipe types by slug, and words that tell a type, tried in this order.
RECIPE_TYPES = {
    "appetizer": "appetizer", "starter": "appetizer", "main": "main", "main-course": "main", "entree": "main", "side": "side", "side-dish": "side",
    "salad": "salad", "soup": "soup", "dessert": "dessert", "breakfast": "breakfast", "snack": "snack", "drink": "drink", "beverage": "drink",
}
TYPE_WORDS = (
    ("salad", ("salad",)), ("appetizer", ("appetizer", "starter")), ("soup", ("soup", "broth", "bisque")), ("dessert", ("dessert", "cake", "cookie", "brownie", "sweet")),
    ("breakfast", ("breakfast",)), ("snack", ("snack",)), ("drink", ("drink", "beverage", "juice", "shake", "smoothie")), ("side", ("side-dish", "side")),
)
MAIN_SLUGS = ("main-course", "dinner", "lunch", "entree")

# Labels of times on a page.
TIME_LABELS = {"preparation": ("prep", "preparation"), "cooking": ("cook", "cooking"), "rest": ("rest", "resting", "marinating", "marinade")}

# File endings of image types.
IMAGE_TYPES = {"image/jpeg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/webp": ".webp", "image/avif": ".avif", "image/svg+xml": ".svg", "image/bmp": ".bmp", "image/tiff": ".tiff"}

# What counts as an amount, and how amounts are written in one way, in this order.
AMOUNT = rf"(?:\d+(?:[./]\d+)?|[{''.join(FRACTIONS)}]|to)"
AMOUNT_STEPS = (
    (r"(?<=^|\s)/(?=\d)", "1/"),
    (r"(?<=\d)\s*/\s+(?=\d+/\d+\b)", " "),
    (r"(^|\s)[~≈](?=\s*\d)", "$1"),
    ("[–—]", " - "),
    (r"(?<=\d)(?=[A-Za-z])", " "),
    (r"(?<=\d)\s*-\s*(?=[A-Za-z])", " "),
    (r"\s+", " "),
)

# Words that leave open which of two things is meant, references to notes, and what these leave behind.
CONNECTOR = r"\b(?:or|and/or)\b"
NOTE = r"(?i)\([^)]*see notes?[^)]*\)\d*\)?"
NOTE_DIGITS = ((r"\s+\d+\)$", ")"), (r"\s+\d+$", ""), (r"(?<=\b[A-Za-z])\s+\d+(?=\)|$)", ""), (r"\(\s*\)", ""), (r"\s+", " "))
