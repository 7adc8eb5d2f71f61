"""Word lists, unit tables and limits that results depend on.

They are data, not logic, and are all parameters of the operators that use them.
"""

# Promotional fragments removed from names, in this order.
PROMO_FRAGMENTS = ("New!", "SALE", "HOT", "Best Seller", "Limited")

# Words that carry no product identity.
FILLER_WORDS = (
    "new", "pack", "promo", "special", "offer", "sale",
    "imported", "local", "premium", "value", "family", "economy",
    "extra", "super", "best", "quality", "original", "classic",
    "buy", "free", "off", "deal", "price", "hot", "top",
    "online", "pakistan", "delivery", "available", "stock",
)

# Known brands; the first one in this order that prefixes a name wins.
KNOWN_BRANDS = (
    "Tapal", "Lipton", "Vital", "Supreme", "Tetley", "Nescafe",
    "Olpers", "Milkpak", "Nurpur", "Haleeb", "Good Milk", "Dairy Queen",
    "Nestle", "Adams",
    "Dalda", "Habib", "Sufi", "Mezan", "Eva", "Seasons", "Soya Supreme",
    "Guard", "Matco", "Falak", "Sunridge", "Reem",
    "Pepsi", "Coca Cola", "7Up", "Sprite", "Fanta", "Dew", "Pakola",
    "Sting", "Red Bull", "Tang", "Rooh Afza",
    "Lays", "Kurkure", "Super Crisp", "Kolson", "Peek Freans", "LU",
    "Bisconni", "Oreo", "Prince",
    "Safeguard", "Lifebuoy", "Lux", "Dove", "Pantene", "Head Shoulders",
    "Sunsilk", "Clear", "Colgate", "Sensodyne", "Close Up", "Pepsodent",
    "Surf Excel", "Ariel", "Bonus", "Brite", "Express Power",
    "Harpic", "Vim", "Dettol",
    "Pampers", "Huggies", "Canbebe", "Baby Dee",
    "National", "Shan", "Mehran",
    "Mitchell", "Shangrila", "National", "Heinz", "Knorr",
)

# Spelling of a unit in a name -> canonical unit (others stay as they are).
UNIT_ALIASES = {
    "gm": "g", "gms": "g", "gram": "g", "grams": "g",
    "ltr": "l", "litre": "l", "liter": "l",
    "pcs": "pcs", "pieces": "pcs", "pack": "pack", "pk": "pack",
    "rolls": "roll", "sachets": "sachet", "tablets": "tablet", "sheets": "sheet",
}

# Factors to the base unit of each family.
WEIGHT_FACTORS = {
    "kg": 1000.0, "g": 1.0, "gm": 1.0, "gms": 1.0, "gram": 1.0, "grams": 1.0,
    "mg": 0.001, "lb": 453.592, "lbs": 453.592,
}
VOLUME_FACTORS = {
    "l": 1000.0, "ltr": 1000.0, "litre": 1000.0, "liter": 1000.0, "ml": 1.0, "cc": 1.0,
}
COUNT_FACTORS = {
    "pcs": 1.0, "pieces": 1.0, "piece": 1.0, "pk": 1.0, "pack": 1.0,
    "sachets": 1.0, "sachet": 1.0, "rolls": 1.0, "roll": 1.0,
    "sheets": 1.0, "sheet": 1.0, "tablets": 1.0, "tablet": 1.0, "caps": 1.0,
}

# Unit spellings inside the size patterns (alternation order matters).
SIZE_UNITS = (
    "kg|g|gm|gms|gram|grams|mg|l|ltr|litre|liter|ml|cc|pcs|pieces|pack|pk"
    "|rolls|sachets|tablets|sheets"
)
KEY_SIZE_UNITS = (
    "kg|g|gm|gms|gram|grams|mg|l|ltr|litre|liter|ml|cc|pcs|pieces|pack|pk"
    "|rolls?|sachets?|tablets?|sheets?"
)

# Exact product type -> category.
CATEGORY_BY_TYPE = {
    "fruits & vegitables": "fruits-vegetables",
    "fruits & vegetables": "fruits-vegetables",
    "snacks & beverages": "snacks-beverages",
    "staples": "staples",
    "daily essentials": "daily-essentials",
    "dairy & fresh bakery": "dairy-bakery",
    "dairy creams": "dairy",
    "packaged food": "packaged-food",
    "drinking water": "beverages",
    "tea & cofee": "tea-coffee",
    "tea & coffee": "tea-coffee",
    "flour": "flour-atta",
    "oil & ghee": "cooking-oil-ghee",
    "baby care": "baby-care",
    "cat food": "pet-care",
    "yogurt": "dairy",
    "chicken": "meat-poultry",
    "chips and nimko": "snacks",
    "spices": "spices",
    "bread": "bakery",
    "flavoured milk": "dairy",
    "biscuits": "snacks",
    "chocolates": "chocolates",
    "chocolate": "chocolates",
    "frozen fries": "frozen-food",
    "cereals": "breakfast",
    "baking items": "baking",
    "dry fruit & dates": "dry-fruits",
    "salt": "staples",
    "candies & bubble gums": "confectionery",
}

# Keyword -> category; the first keyword in this order that occurs wins.
CATEGORY_BY_KEYWORD = {
    "fruit": "fruits-vegetables", "vegetable": "fruits-vegetables",
    "meat": "meat-poultry", "chicken": "meat-poultry", "beef": "meat-poultry",
    "milk": "dairy", "cheese": "dairy", "butter": "dairy", "yogurt": "dairy",
    "rice": "staples", "flour": "flour-atta", "atta": "flour-atta",
    "oil": "cooking-oil-ghee", "ghee": "cooking-oil-ghee",
    "tea": "tea-coffee", "coffee": "tea-coffee",
    "juice": "beverages", "water": "beverages", "drink": "beverages",
    "snack": "snacks", "chip": "snacks", "biscuit": "snacks",
    "chocolate": "chocolates", "candy": "confectionery",
    "frozen": "frozen-food", "ice cream": "frozen-food",
    "spice": "spices", "masala": "spices",
    "soap": "personal-care", "shampoo": "personal-care",
    "detergent": "household", "cleaner": "household",
    "baby": "baby-care", "diaper": "baby-care",
    "pet": "pet-care", "cat food": "pet-care", "dog food": "pet-care",
}

# Limits and targets.
PRICE_CEILING = 100_000.0
SUSPICIOUS_PRICE = 50_000.0
TARGET_RAW_ROWS = 500_000
TARGET_MATCHED = 10_000
FUZZY_CUTOFF = 55.0
