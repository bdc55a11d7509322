"""Fixed vocabularies. The values must equal the ones the data was labelled with, so they stand here plainly."""

from __future__ import annotations

# Section types; their order defines vector dimensions 0..27.
SECTION_TYPES = (
    "announcement_bar", "hero_full_bleed", "hero_split", "hero_slideshow", "hero_bento", "hero_minimal", "trust_bar",
    "marquee", "logo_bar", "testimonial_cards", "testimonial_marquee", "ugc_gallery", "stats_bar", "featured_products",
    "product_carousel", "featured_product", "category_pills", "category_grid", "collection_banner", "lookbook",
    "about_brand", "image_with_text", "video_section", "quote_block", "newsletter", "countdown_timer", "recently_viewed",
    "rich_text",
)

# Section types that ask for an action, and those that show products.
CTA_TYPES = ("newsletter", "collection_banner", "countdown_timer", "hero_full_bleed", "hero_split", "hero_slideshow", "featured_products")
FINGERPRINT_CTA = ("newsletter", "collection_banner", "countdown_timer")
PRODUCT_TYPES = ("featured_products", "product_carousel", "featured_product")

# Dimensions 28..41 by name, and each vertical's weights where they differ from 1.
FEATURE_DIMS = (
    "avg_image_ratio", "avg_text_density", "button_density", "avg_luminance", "dark_section_ratio", "section_count",
    "hero_height_ratio", "has_carousel", "has_marquee", "max_grid_columns", "is_dark_theme", "gold_proportion",
    "maroon_proportion", "accent_saturation",
)
VERTICAL_WEIGHTS = {
    "jewellery": {"gold_proportion": 3.0, "maroon_proportion": 2.0, "is_dark_theme": 2.0, "accent_saturation": 2.5},
    "fashion": {"hero_height_ratio": 2.0, "has_carousel": 1.5, "avg_image_ratio": 2.0},
    "food": {"section_count": 1.5, "button_density": 2.0, "has_carousel": 0.5},
    "beauty": {"accent_saturation": 2.0, "avg_luminance": 1.5, "hero_height_ratio": 1.5},
}

# Words in headings that tell a vertical, in order.
VERTICAL_WORDS = (
    ("jewellery", "jewel|ring|necklace|bracelet|gold|diamond|bridal"),
    ("fashion", "dress|fashion|wear|cloth|saree|kurta|lehenga"),
    ("beauty", "beauty|skin|makeup|cosmetic|glow|serum"),
    ("food", "food|snack|spice|tea|coffee|organic|farm"),
    ("homedecor", "home|decor|furniture|living|kitchen"),
    ("electronics", "tech|gadget|phone|laptop|electronic"),
    ("wellness", "wellness|health|yoga|ayurved|fitness"),
)

# Font pairings as id, heading font, body font, vibes, verticals.
FONT_PAIRINGS = (
    ("fp_01", "Playfair Display", "Source Sans Pro", "luxury editorial", "fashion jewellery"),
    ("fp_02", "Cormorant Garamond", "Proza Libre", "elegant traditional", "jewellery fashion"),
    ("fp_03", "Libre Baskerville", "Open Sans", "classic trustworthy", "general homedecor"),
    ("fp_04", "Montserrat", "Open Sans", "modern clean", "general electronics"),
    ("fp_05", "Poppins", "Inter", "modern friendly", "general beauty wellness"),
    ("fp_06", "DM Sans", "Inter", "minimal tech", "electronics general"),
    ("fp_07", "Space Grotesk", "DM Sans", "bold contemporary", "fashion electronics"),
    ("fp_08", "Fraunces", "Commissioner", "warm artisanal", "food wellness"),
    ("fp_09", "Lora", "Nunito Sans", "warm approachable", "food beauty"),
    ("fp_10", "Merriweather", "Lato", "readable warm", "general food"),
    ("fp_11", "Oswald", "Roboto", "bold impact", "fashion electronics"),
    ("fp_12", "Bebas Neue", "Open Sans", "urban strong", "fashion"),
    ("fp_13", "Archivo Black", "Work Sans", "statement edgy", "fashion"),
    ("fp_14", "Tenor Sans", "Jost", "soft feminine", "beauty wellness jewellery"),
    ("fp_15", "Josefin Sans", "Quicksand", "delicate airy", "beauty wellness"),
    ("fp_16", "EB Garamond", "Source Serif Pro", "traditional ethnic", "jewellery fashion"),
    ("fp_17", "Spectral", "Karla", "heritage refined", "jewellery homedecor"),
    ("fp_18", "Sora", "Nunito", "playful youth", "general food"),
    ("fp_19", "Outfit", "Plus Jakarta Sans", "fresh dynamic", "general beauty"),
    ("fp_20", "Inter", "Inter", "neutral system", "general electronics"),
)
# Fonts that stand for another one.
FONT_ALIASES = (
    ("Arial", "Inter"), ("Helvetica", "Inter"), ("Helvetica Neue", "Inter"), ("system-ui", "Inter"), ("-apple-system", "Inter"),
    ("BlinkMacSystemFont", "Inter"), ("Segoe UI", "Inter"), ("Times New Roman", "Libre Baskerville"), ("Georgia", "Lora"),
    ("Verdana", "Open Sans"), ("Tahoma", "Open Sans"), ("Trebuchet MS", "Nunito Sans"), ("Courier New", "Space Mono"),
)

# Section-id rules in order. Each is a type and alternatives; an alternative is words that all must occur.
ID_RULES = (
    ("header", "header", "nav"), ("footer", "footer"), ("announcement_bar", "announcement", "global-banner"),
    ("hero", "hero", "full-bleed"), ("slideshow", "slideshow", "slider", "carousel"), ("featured_products", "featured+product"),
    ("featured_collection", "featured+collection"), ("collection_list", "collection+list"), ("collection", "collection", "category"),
    ("product_carousel", "product+carousel"), ("product_grid", "product+grid"), ("product", "product"),
    ("testimonials", "testimonial", "review"), ("newsletter", "newsletter", "subscribe", "email"), ("image_with_text", "image+text"),
    ("rich_text", "rich+text"), ("rich_text", "richtext"), ("video", "video"), ("logo_bar", "logo", "brand"), ("blog", "blog", "article"),
    ("contact", "map", "contact"), ("cart_drawer", "cart+drawer"), ("cart", "cart"), ("popup", "popup", "modal"),
    ("promo_tiles", "promo", "tile"), ("shopping_grid", "shopping+grid"), ("style_panel", "style+panel"), ("seo", "seo"),
    ("geofencing", "geofenc", "geo"), ("marquee", "marquee", "ticker"), ("trust_bar", "trust", "usp", "guarantee"), ("hero", "banner"),
    ("spacer", "spacer", "divider"), ("quick_links", "quick_links", "quick-links"),
    ("flexible_content", "flexible", "content_row", "content-row"), ("image_with_text", "fifty_fifty", "fifty-fifty", "split"),
    ("featured_products", "featured_content", "featured-content"), ("rich_text", "about", "story", "mission"),
    ("collection", "categories"), ("rich_text", "paragraph", "generic_text", "generic-text"),
    ("featured_products", "newest", "new-arrival", "new_arrival"), ("featured_products", "featured-block", "featured_block"),
    ("rewards_bar", "reward", "loyalty", "treecounter"), ("promo_tiles", "animated", "cards"),
    ("social_feed", "ig-feed", "ig_feed", "instagram"), ("utility", "swatch", "badges", "redirect", "minisearch"),
    ("app_embed", "protect", "bopis", "optimization", "chatbot"), ("visual_effect", "fireworks", "gradient", "screen-effect"),
)

# roles' default colours.
DEFAULT_BACKGROUND, DEFAULT_ACCENT = "#FFFFFF", "#C5A455"


def weights(vertical: str) -> list[float]:
    """The 42 weights of a vertical; unknown ones weigh all dimensions alike."""
    own = VERTICAL_WEIGHTS.get(vertical, {})
    return [1.0] * len(SECTION_TYPES) + [own.get(d, 1.0) for d in FEATURE_DIMS]
