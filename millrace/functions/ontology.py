"""Fixed values of the corpus: extensions, source tags, class names and their translations."""

from __future__ import annotations

#: Image extensions, which differ by operator.
EXTS_ALL = ("png", "jpg", "jpeg", "bmp", "gif", "webp")
EXTS_NO_GIF = ("jpg", "jpeg", "png", "bmp", "webp")
EXTS_MODEL = ("jpg", "jpeg", "png", "webp")

#: Source tags in the order in which they are looked for, and those that stop a rename.
SOURCE_TAGS = ("cd", "pd", "ac", "ap", "kd")
RENAMED_TAGS = ("cd", "pd")

#: Chinese crop names.
CROP_ZH = {
    "Apple": "苹果", "Bell_pepper": "甜椒", "Blueberry": "蓝莓", "Cherry": "樱桃", "Corn": "玉米", "Peach": "桃", "Potato": "马铃薯",
    "Raspberry": "覆盆子", "Rice": "稻", "Soyabean": "大豆", "Soybean": "大豆", "Squash": "南瓜", "Strawberry": "草莓", "Sugarcane": "甘蔗",
    "Tomato": "番茄", "Wheat": "小麦", "grape": "葡萄", "almond": "杏仁", "banana": "香蕉", "cardamom": "小豆蔻", "clove": "丁香",
    "coconut": "椰子", "cotton": "棉花", "gram": "鹰嘴豆", "jowar": "高粱", "jute": "黄麻", "kag2": "Kaggle补充", "maize": "玉米",
    "mustard-oil": "芥籽", "papaya": "木瓜", "pineapple": "菠萝", "rice": "稻", "soyabean": "大豆", "soybean": "大豆", "sugarcane": "甘蔗",
    "sunflower": "向日葵", "tea": "茶树", "tomato": "番茄", "vigna-radiati(Mung)": "绿豆", "wheat": "小麦", "Olive-tree": "橄榄树",
    "Coffee-plant": "咖啡树", "Tobacco-plant": "烟草", "Fox_nut(Makhana)": "芡实", "Pearl_millet(bajra)": "珍珠粟",
}

#: Parts of names that tell of a disease.
DISEASE_TOKENS = ("blight", "rust", "spot", "mildew", "virus", "mite", "rot", "bacterial", "blast", "septoria", "mold", "scab")

#: Classes of the crop-disease set and what they are called here.
CLASS_MAP = {
    "Corn___Common_Rust": "Corn rust leaf", "Corn___Gray_Leaf_Spot": "Corn Gray leaf spot", "Corn___Northern_Leaf_Blight": "Corn leaf blight",
    "Corn___Healthy": "Corn leaf", "Potato___Early_Blight": "Potato leaf early blight", "Potato___Late_Blight": "Potato leaf late blight",
    "Potato___Healthy": "Potato leaf", "Rice___Brown_Spot": "Rice brown spot", "Rice___Leaf_Blast": "Rice leaf blast", "Rice___Neck_Blast": "Rice neck blast",
    "Rice___Healthy": "Rice leaf", "Sugarcane_Bacterial Blight": "Sugarcane bacterial blight", "Sugarcane_Red Rot": "Sugarcane red rot",
    "Sugarcane_Healthy": "Sugarcane leaf", "Wheat___Brown_Rust": "Wheat brown rust", "Wheat___Yellow_Rust": "Wheat yellow rust", "Wheat___Healthy": "Wheat leaf",
}

#: Source class (lower case, no trailing " plant") and the folder that holds it.
CLASS_ALIASES = {
    "maize (corn)": "maize", "corn": "maize", "rice (paddy)": "rice", "wheat": "wheat", "tomatoes": "tomato", "bananas": "banana", "coconuts": "coconut",
    "coffee (green)": "Coffee-plant", "olives": "Olive-tree", "soybeans": "soyabean", "pineapples": "pineapple", "papayas": "papaya", "sunflowers": "sunflower",
    "tea": "tea", "jute": "jute", "sorghum": "jowar", "cucumbers and gherkins": "Cucumber", "tobacco plant": "Tobacco-plant", "sugar cane": "sugarcane",
    "cardamom": "cardamom", "cloves": "clove", "almonds": "almond", "cherry": "Cherry", "fox nut(makhana)": "Fox_nut(Makhana)", "fox nut (makhana)": "Fox_nut(Makhana)",
    "pearl millet (bajra)": "Pearl_millet(bajra)", "pearl millet(bajra)": "Pearl_millet(bajra)", "lemons": "Lemon", "lemon": "Lemon", "mung bean": "vigna-radiati(Mung)",
    "chili peppers and green peppers": "chilli", "aji pepper": "chilli", "habanero pepper": "chilli", "green peppers": "chilli", "green pepper": "chilli",
    "chilli": "chilli", "chili": "chilli", "chile": "chilli",
}

#: The class map, names as they occur and the class of each.
CLASS_NAMES = {
    "Aji pepper plant": "chilli", "Almonds plant": "almond", "Apple Apple scab": "Apple Scab Leaf", "Apple Cedar apple rust": "Apple rust leaf",
    "Apple Scab Leaf": "Apple Scab Leaf", "Apple leaf": "Apple leaf", "Apple rust leaf": "Apple rust leaf", "Bananas plant": "banana",
    "Bell_pepper leaf": "Bell_pepper leaf", "Bell_pepper leaf spot": "Bell_pepper leaf spot", "Blueberry leaf": "Blueberry leaf", "Cherry": "Cherry",
    "Cherry leaf": "Cherry leaf", "Cherry plant": "Cherry", "Chili peppers and green peppers plant": "chilli", "Cloves plant": "clove", "Cocoa beans plant": "cocoa",
    "Coconuts plant": "coconut", "Coffee (green) plant": "Coffee-plant", "Coffee-plant": "Coffee-plant", "Corn Gray leaf spot": "Corn Gray leaf spot",
    "Corn leaf": "Corn leaf", "Corn leaf blight": "Corn leaf blight", "Corn rust leaf": "Corn rust leaf", "Cucumber": "Cucumber",
    "Cucumbers and gherkins plant": "Cucumber", "Fox_nut(Makhana)": "Fox_nut(Makhana)", "Grape Black rot": "grape leaf black rot", "Jute plant": "jute", "Lemon": "Lemon",
    "Maize (Corn) plant": "maize", "Mung bean plant": "vigna-radiati(Mung)", "Olive-tree": "Olive-tree", "Olives plant": "Olive-tree", "Papayas plant": "papaya",
    "Peach leaf": "Peach leaf", "Pearl_millet(bajra)": "Pearl_millet(bajra)", "Pineapples plant": "pineapple", "Potato leaf": "Potato leaf",
    "Potato leaf early blight": "Potato leaf early blight", "Potato leaf late blight": "Potato leaf late blight", "Raspberry leaf": "Raspberry leaf",
    "Rice (Paddy) plant": "rice", "Rice brown spot": "Rice brown spot", "Rice leaf": "Rice leaf", "Rice leaf blast": "Rice leaf blast",
    "Rice neck blast": "Rice neck blast", "Sorghum plant": "jowar", "Soyabean leaf": "Soyabean leaf", "Soybean leaf": "Soyabean leaf", "Soybeans plant": "soyabean",
    "Squash Powdery mildew": "Squash Powdery mildew leaf", "Squash Powdery mildew leaf": "Squash Powdery mildew leaf", "Strawberry leaf": "Strawberry leaf",
    "Sugar cane plant": "sugarcane", "Sugarcane bacterial blight": "Sugarcane bacterial blight", "Sugarcane leaf": "Sugarcane leaf",
    "Sugarcane red rot": "Sugarcane red rot", "Tea plant": "tea", "Tobacco-plant": "Tobacco-plant", "Tomato Early blight leaf": "Tomato Early blight leaf",
    "Tomato Septoria leaf spot": "Tomato Septoria leaf spot", "Tomato leaf": "Tomato leaf", "Tomato leaf bacterial spot": "Tomato leaf bacterial spot",
    "Tomato leaf early blight": "Tomato Early blight leaf", "Tomato leaf late blight": "Tomato leaf late blight", "Tomato leaf mold": "Tomato mold leaf",
    "Tomato leaf mosaic virus": "Tomato leaf mosaic virus", "Tomato leaf yellow virus": "Tomato leaf yellow virus", "Tomato mold leaf": "Tomato mold leaf",
    "Tomato two spotted spider mites": "Tomato two spotted spider mites leaf", "Tomato two spotted spider mites leaf": "Tomato two spotted spider mites leaf",
    "Tomatoes plant": "tomato", "Wheat brown rust": "Wheat brown rust", "Wheat leaf": "Wheat leaf", "Wheat plant": "wheat", "Wheat yellow rust": "Wheat yellow rust",
    "almond": "almond", "ants": "ants", "banana": "banana", "bees": "bees", "beetle": "beetle", "cardamom": "cardamom", "caterpillar": "caterpillar", "chilli": "chilli",
    "clove": "clove", "coconut": "coconut", "cotton": "cotton", "earthworms": "earthworms", "earwig": "earwig", "gram": "gram", "grape leaf": "grape leaf",
    "grape leaf black rot": "grape leaf black rot", "grasshopper": "grasshopper", "jowar": "jowar", "jute": "jute", "maize": "maize", "moth": "moth",
    "mustard-oil": "mustard-oil", "papaya": "papaya", "pineapple": "pineapple", "rice": "rice", "slug": "slug", "snail": "snail", "soyabean": "soyabean",
    "sugarcane": "sugarcane", "sunflower": "sunflower", "tea": "tea", "tomato": "tomato", "vigna-radiati(Mung)": "vigna-radiati(Mung)", "wasp": "wasp",
    "weevil": "weevil", "wheat": "wheat",
}

#: crop_disease classes, as rules in order: crop (None: any), words of which all must occur, and the name.
DISEASE_RULES = (
    ("Corn*", ("cercospora",), "Corn Gray leaf spot"), ("Corn*", ("gray leaf spot",), "Corn Gray leaf spot"), ("Corn*", ("common rust",), "Corn rust leaf"),
    ("Corn*", ("northern leaf blight",), "Corn leaf blight"), ("Apple", ("cedar apple rust",), "Apple rust leaf"), ("Apple", ("apple scab",), "Apple Scab Leaf"),
    ("Apple", ("black rot",), "Apple leaf black rot"), ("Tomato", ("bacterial spot",), "Tomato leaf bacterial spot"), ("Tomato", ("early blight",), "Tomato Early blight leaf"),
    ("Tomato", ("late blight",), "Tomato leaf late blight"), ("Tomato", ("leaf mold",), "Tomato mold leaf"), ("Tomato", ("mosaic virus",), "Tomato leaf mosaic virus"),
    ("Tomato", ("yellow leaf curl virus",), "Tomato leaf yellow virus"), ("Tomato", ("spider", "mite"), "Tomato two spotted spider mites leaf"),
    ("Tomato", ("septoria",), "Tomato Septoria leaf spot"), ("Tomato", ("target spot",), "Tomato target spot leaf"), ("Bell_pepper", ("bacterial spot",), "Bell_pepper leaf spot"),
    ("Squash", ("powdery mildew",), "Squash Powdery mildew leaf"), ("grape", ("black rot",), "grape leaf black rot"), ("grape", ("isariopsis",), "grape leaf blight"),
    ("grape", ("leaf blight",), "grape leaf blight"), ("grape", ("esca",), "grape leaf black measles"), ("grape", ("black measles",), "grape leaf black measles"),
    ("Peach", ("bacterial spot",), "Peach leaf bacterial spot"), ("Orange", ("citrus greening",), "Orange citrus greening leaf"), ("Orange", ("haunglongbing",), "Orange citrus greening leaf"),
)
