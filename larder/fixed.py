"""Word lists, patterns, column names, templates and constants.

Results are only right when these equal the published ones, so they are stated
here as plain text, in their natural order. Every operator takes them as
default arguments; none is read from anywhere else.
"""

# --- fixed values: corpus schema -------------------------------------------
REQUIRED_COLUMNS = ["name", "category", "glass", "ingredients", "instructions"]
OPTIONAL_COLUMNS = ["alcoholic", "thumbnail", "tags", "iba", "source"]

# First present candidate wins.
COLUMN_CANDIDATES = {
    "name": ["name", "strDrink", "drink_name", "cocktail_name", "title"],
    "category": ["category", "strCategory", "type", "cocktail_type"],
    "glass": ["glass", "strGlass", "glass_type", "serve_in"],
    "ingredients": ["ingredients", "ingredient_list", "strIngredients", "recipe"],
    "instructions": ["instructions", "preparation", "directions", "method", "strInstructions"],
}

# Raw wide record: text columns, then numbered ingredient and measure slots.
WIDE_COLUMNS = {
    "strDrink": "name",
    "strCategory": "category",
    "strGlass": "glass",
    "strInstructions": "instructions",
}
WIDE_INGREDIENT = "strIngredient"
WIDE_MEASURE = "strMeasure"
WIDE_SLOTS = 15

# Fields of one payload record, besides the numbered slots.
PAYLOAD_FIELDS = {
    "id": "idDrink",
    "name": "strDrink",
    "category": "strCategory",
    "alcoholic": "strAlcoholic",
    "glass": "strGlass",
    "instructions": "strInstructions",
    "thumbnail": "strDrinkThumb",
    "tags": "strTags",
    "iba": "strIBA",
}
PAYLOAD_ARRAY = "drinks"
PAYLOAD_SOURCE = "cocktaildb"

# Source cascade: file stems and the tag each one gives its rows.
MERGED_STEM, MERGED_TAG = "cocktails_merged", "cocktaildb_merged"
MAIN_STEMS = ["cocktaildb_main", "cocktails"]
SECOND_STEMS = {"iba_cocktails": "iba", "cocktaildb_nonalcoholic": "nonalcoholic"}
EXTRA_PREFIX = "kaggle_"

# --- fixed values: keyword lexicon (matched as substrings) ------------------
FLAVOR_LEXICON = {
    "sweet": ["sugar", "syrup", "liqueur", "triple sec", "grenadine", "honey", "creme", "baileys", "amaretto", "kahlua"],
    "sour": ["lemon", "lime", "citrus", "juice", "sour", "vinegar", "tamarind"],
    "bitter": ["bitters", "campari", "aperol", "angostura", "amaro", "vermouth dry", "cynar", "fernet"],
    "strong": ["vodka", "gin", "rum", "tequila", "whiskey", "bourbon", "brandy", "cognac", "mezcal", "absinthe", "everclear"],
    "fresh": ["mint", "cucumber", "basil", "soda", "tonic", "ginger beer", "club soda", "sparkling", "prosecco", "champagne"],
    "fruity": ["orange", "pineapple", "mango", "berry", "strawberry", "passion", "peach", "coconut", "raspberry", "blueberry", "cherry"],
}
LEXICON_SATURATION = 3.0

# --- fixed values: text patterns --------------------------------------------
MEASURE_PATTERNS = {
    "index": r"\d+(\.\d+)?\s*(ml|oz|cl|dash|tsp|tbsp|cup|part|drop|pinch|splash|shot)\s*",
    "explore": r"\d+(?:ml|cl|oz|tsp|tbsp)?\s*",
    "clean": r"\d+(?:\.\d+)?\s*(?:ml|cl|oz|tsp|tbsp|cup|dash)?",
    "browse": r"\d+ml\s*",
}
LIST_SEPARATOR = r"[,\n]"
NOT_PLAIN_TEXT = r"[^a-zA-Z0-9 ,.!?\-]"
MIN_TERM_CHARS = 3

# --- fixed values: retrieval ------------------------------------------------
EMBEDDING_DIM = 384
TOP_K = 5
ANSWER_TOP_K = 3
GUARDRAIL_THRESHOLD = 0.40
SEMANTIC_WEIGHT = 0.5
COVERAGE_WEIGHT = 0.5
MASKED_SCORE = -1.0
TFIDF_FEATURES = 5000
OTHER_LABEL = "Autre"
ANSWER_TEMPERATURE = 0.7

# --- fixed values: evaluation -----------------------------------------------
K_VALUES = [1, 3, 5, 10]
OUT_OF_DOMAIN_REQUESTS = [
    "repare mon velo",
    "quelle est la capitale de la France",
    "recommande-moi un film",
    "code un algorithme de tri",
    "meteorologie de demain",
]
IN_DOMAIN_REQUESTS = [
    "cocktail avec vodka et citron",
    "quelque chose de frais et sucre",
    "mojito ou daiquiri",
    "recette avec rhum et menthe",
    "long drink pour ete",
]
GAIN_FLOOR = 1e-9
BLEU_ORDER = 4
BLEU_EPSILON = 0.1

# --- fixed values: clustering -----------------------------------------------
CLUSTER_SEED = 42
CLUSTER_STARTS = 10
CLUSTER_RANGE = range(3, 16)
SILHOUETTE_SAMPLE = 500

# --- fixed values: text formats ---------------------------------------------
END_OF_TEXT = "<|endoftext|>"
UNNAMED_ITEM = "Unknown Cocktail"
INGREDIENT_REQUEST_PREFIX = "cocktail avec "
GENERATION_PROMPT = ("Recette avec ", " :\nNom : ")
CONTEXT_LABELS = {
    "Cocktail : ": "name",
    "Categorie : ": "category",
    "Ingredients : ": "ingredients",
    "Instructions : ": "instructions",
}
CONTEXT_SEPARATOR = "\n---\n"
CONTEXT_LINES = 6
REJECTION_REASON = "Requete hors-domaine cocktails."
PROMPT_HEAD = (
    "You are an expert mixologist. Create an original and creative cocktail recipe.\n\n"
    "Reference cocktails (use them as inspiration):\n"
)
PROMPT_REQUEST = "\n\nRequest: "
PROMPT_TAIL = (
    "\n\nGenerate a complete recipe with:\n"
    "- Cocktail name\n"
    "- Ingredients with precise measurements\n"
    "- Step-by-step instructions\n"
    "- Tasting note (1 sentence)"
)
TEMPLATE_HEAD = ("Recette generee pour '", "' (mode template)\n\n")
TEMPLATE_TAIL = (
    "\n\nPreparation : Combiner les ingredients dans un shaker avec de la glace. "
    "Agiter 15 secondes. Filtrer et servir dans le verre approprie."
)

# --- fixed values: languages ------------------------------------------------
SKIPPED_LANGUAGES = ["en", "unknown"]
DISPLAY_COLUMNS = {"name": "Nom", "category": "Categorie", "glass": "Verre", "ingredients": "Ingredients"}
