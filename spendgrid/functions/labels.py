"""Names, texts and cut-offs that reports rely on word for word."""

# Segment names in order of average spend, highest first.
SEGMENTS = ["Champions", "Loyal High Value", "Steady Mid-Tier", "At Risk", "Dormant"]

# name -> (description, recommended action)
SEGMENT_TEXTS = {
    "Champions": (
        "Highest-value customers with strong recent activity. They spend the most per transaction and across the most "
        "categories. Priority: retain with exclusive offers and early access.",
        "Retain & Reward",
    ),
    "Loyal High Value": (
        "Consistently high spenders with the highest transaction frequency. They shop across many merchants regularly. "
        "Priority: reward loyalty, cross-sell into new categories.",
        "Cross-Sell & Grow",
    ),
    "Steady Mid-Tier": (
        "Reliable middle-ground customers with moderate spend and frequency. Largest segment by count. Priority: upsell "
        "to higher tiers with targeted promotions.",
        "Upsell & Activate",
    ),
    "At Risk": (
        "Previously active customers showing declining engagement — lower frequency and higher recency. Priority: "
        "re-engagement campaigns before they churn.",
        "Re-Engage",
    ),
    "Dormant": (
        "Lowest spend and frequency with the longest gaps between purchases. At high risk of full churn. Priority: "
        "win-back offers or accept natural attrition.",
        "Win-Back or Release",
    ),
}

# Lower limit of the churn probability and level, highest first.
CHURN_LEVELS = [(0.8, "Critical"), (0.6, "High"), (0.4, "Medium"), (0.2, "Low"), (None, "Stable")]
AT_RISK = ["Critical", "High"]

# Tier of quintile 5 down to 1.
CLV_TIERS = ["Platinum", "Gold", "Silver", "Bronze", "Basic"]

# Relative change limits, highest first.
MOMENTUM = [(0.2, "Accelerating"), (-0.05, "Steady"), (-0.3, "Slowing"), (None, "Declining")]
HEALTH = [(0.1, "Growing"), (-0.05, "Stable"), (-0.15, "Slowing"), (None, "Declining")]

# Adoption rate limits in percent, highest first.
PROPENSITY = [(60, "Very High"), (40, "High"), (20, "Medium"), (10, "Low"), (None, "Very Low")]

# Share-of-wallet limits in percent, highest first.
WALLET_BANDS = [
    (80, "80-100% (Loyalist)"),
    (50, "50-80% (Primary)"),
    (20, "20-50% (Secondary)"),
    (None, "1-20% (Occasional)"),
]

PITCH_ACTIONS = {
    "leader": "Defend - you are the leader, retain customers",
    "grow": "Grow - strong position, push for more share",
    "protect": "Protect - good share but churn risk is high",
    "attack": "Attack - low share but high value customers",
    "opportunity": "Opportunity - low share, room to grow",
    "other": "Monitor",
}

# Audience id -> (name, type, description)
AUDIENCES = {
    "D01": (
        "Affluent professionals",
        "Demographic",
        "High-income professionals aged 25-55. Strong purchasing power across categories.",
    ),
    "D02": (
        "Emerging middle class",
        "Demographic",
        "Middle-income consumers (R23k-R56k). Growing spending power, price-conscious but aspirational.",
    ),
    "D03": (
        "Young adults 18-25",
        "Demographic",
        "Young adults 18-25. Digital-first, trend-driven, lower basket but high frequency potential.",
    ),
    "D04": (
        "Senior spenders 55+",
        "Demographic",
        "Customers aged 55+. Higher average basket, brand loyal, health and wellness oriented.",
    ),
    "D05": (
        "High income female",
        "Demographic",
        "High-income female consumers. Over-index in fashion, groceries, health.",
    ),
    "D06": ("High income male", "Demographic", "High-income male consumers. Over-index in auto, electronics, fuel."),
    "D07": (
        "Young families 26-40",
        "Demographic",
        "Young families aged 26-40 with middle+ income. Groceries, kids, household heavy.",
    ),
    "L01": (
        "Food lovers",
        "Lifestyle",
        "Customers who spend 40%+ on food categories (groceries, restaurants, food delivery).",
    ),
    "L02": (
        "Fashion forward",
        "Lifestyle",
        "Customers who spend 25%+ on fashion (clothing, footwear, accessories).",
    ),
    "L03": ("Auto enthusiasts", "Lifestyle", "Customers who spend 30%+ on automotive (fuel, parts, accessories)."),
    "L04": ("Health & wellness", "Lifestyle", "Customers who spend 15%+ on health (pharmacy, fitness, wellness)."),
    "L05": (
        "Home improvers",
        "Lifestyle",
        "Customers who spend 20%+ on home improvement (hardware, furniture, decor).",
    ),
    "L06": ("Tech savvy", "Lifestyle", "Customers who spend 20%+ on technology (electronics, telecoms)."),
    "L07": (
        "Travel & leisure",
        "Lifestyle",
        "Customers who spend 15%+ on travel and leisure (flights, hotels, entertainment).",
    ),
    "B01": (
        "High value champions",
        "Behavioral",
        "Top 8% of customers by spend and engagement. Highest value, most active.",
    ),
    "B02": (
        "Loyal high value",
        "Behavioral",
        "Second tier — consistent high spenders with strong merchant diversity.",
    ),
    "B03": (
        "At-risk high spenders",
        "Behavioral",
        "High historical spend but flagged as churn risk. Re-engagement priority.",
    ),
    "B04": (
        "Accelerating spenders",
        "Behavioral",
        "Customers whose recent 6m spend exceeds prior 6m. Growing value.",
    ),
    "B05": (
        "Declining high value",
        "Behavioral",
        "High spenders whose spend is trending down. Retention intervention needed.",
    ),
    "B06": (
        "Frequent transactors",
        "Behavioral",
        "Customers with 500+ transactions in 12 months. Ultra-frequent buyers.",
    ),
    "B07": (
        "Multi-category shoppers",
        "Behavioral",
        "Customers active in 8+ categories. Broad lifestyle, high cross-sell potential.",
    ),
    "G01": ("Gauteng metro", "Geographic", "All customers located in Gauteng province."),
    "G02": ("Western Cape", "Geographic", "All customers located in Western Cape province."),
    "G03": ("KwaZulu-Natal", "Geographic", "All customers located in KwaZulu-Natal province."),
    "G04": ("Eastern Cape", "Geographic", "All customers located in Eastern Cape province."),
    "S01": (
        "Black Friday power shoppers",
        "Seasonal",
        "Customers who spent 2x+ their monthly average in November. Discount-driven.",
    ),
    "S02": (
        "Festive season splurgers",
        "Seasonal",
        "Customers who spent 1.5x+ their monthly average in December. Festive spenders.",
    ),
    "S03": (
        "Back to school parents",
        "Seasonal",
        "Customers with elevated January spend. Likely parents preparing for school.",
    ),
    "S04": (
        "Pay day shoppers",
        "Seasonal",
        "Customers who concentrate 50%+ of transactions around pay day (25th-3rd).",
    ),
    "X01": (
        "Premium lifestyle bundle",
        "Cross-category",
        "Active in 3+ premium categories (fashion, travel, dining, health, electronics).",
    ),
    "X02": (
        "Grocery + clothing crossover",
        "Cross-category",
        "Significant spend in both groceries AND clothing. Strong cross-sell opportunity.",
    ),
}

# Audience id of the geographic rules -> province.
PROVINCE_AUDIENCES = {
    "G01": "GAUTENG",
    "G02": "WESTERN CAPE",
    "G03": "KWAZULU-NATAL",
    "G04": "EASTERN CAPE",
}

# Lifestyle audience id -> (categories, minimum share, minimum spend).
LIFESTYLE = {
    "L01": (["Groceries", "Restaurants", "Food & Beverage"], 0.4, 5000.0),
    "L02": (["Clothing & Apparel", "Footwear", "Accessories"], 0.25, 3000.0),
    "L03": (["Fuel & Energy", "Automotive", "Auto Accessories"], 0.3, 5000.0),
    "L04": (["Health", "Pharmacy", "Fitness", "Wellness"], 0.15, 2000.0),
    "L05": (["Hardware", "Furniture", "Home & Garden", "Home Decor"], 0.2, 3000.0),
    "L06": (["Electronics", "Telecoms", "Technology"], 0.2, 2000.0),
    "L07": (["Travel", "Accommodation", "Airlines", "Entertainment"], 0.15, 3000.0),
}
PREMIUM_CATEGORIES = ["Clothing & Apparel", "Travel", "Restaurants", "Health", "Electronics"]

# Seasonal audience id -> (calendar month, multiple of the mean amount, minimum spend).
SEASONAL = {"S01": (11, 2.0, 1000.0), "S02": (12, 1.5, 1000.0), "S03": (1, 1.5, 500.0)}
