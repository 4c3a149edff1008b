"""Cleaning of strings, numbers, symbols and keywords as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords that say nothing about a company.
BLOCKED = (
    "securities fraud", "class action", "class action lawsuit", "shareholder lawsuit", "shareholder investigation", "shareholder rights",
    "shareholder class action", "merger investigation", "merger and acquisition", "m&a transaction", "m&a", "securities investigation",
    "securities class action", "securities lawsuit", "securities litigation", "securities claims", "securities law", "securities law firm",
    "sec violations", "sec investigation", "doj investigation", "doj complaint", "lead plaintiff", "lead plaintiff deadline",
    "investor lawsuit", "investor rights", "investor losses", "investor harm", "false statements", "false claims", "false claims act",
    "misleading statements", "misleading disclosures", "financial misstatement", "financial restatement", "financial misconduct",
    "financial misrepresentation", "financial reporting", "fiduciary duty breach", "fiduciary duty", "unreconciled cash balance",
    "internal controls", "internal controls weakness", "material weaknesses", "illegal kickbacks", "kickbacks", "stock price decline",
    "stock decline", "stock exit", "securities", "lawsuit", "investigation", "litigation", "growth stock", "top stock", "best stock",
    "undervalued", "overvalued", "top pick", "buy alert", "stock market", "wall street", "investing", "trading", "technical analysis",
    "breakout", "pullback", "support level", "resistance", "bull market", "bear market", "correction", "rally", "sell-off", "earnings",
    "news", "acquisition", "dividend", "markets", "merger", "movers", "valuation", "buyback", "insider", "ratings", "equity", "small cap",
    "penny stocks", "trading ideas", "shareholder returns", "analyst ratings", "analyst upgrades", "analyst downgrades", "price target",
    "financial results", "earnings reports", "earnings release", "quarterly results", "quarterly earnings", "quarterly dividend",
    "intraday update", "pre-market outlook", "pre-market", "after hours", "conference call", "market growth", "long ideas",
    "revenue growth", "dividend yield", "dividend stocks", "stock repurchase", "share repurchase", "shareholder meeting", "annual meeting",
    "board of directors", "institutional ownership", "insider trading", "insider buying", "insider selling", "analyst report",
    "analyst coverage", "price targets", "recommendation", "earnings releases and operating results", "manda",
)
# Keywords of two characters that are kept.
SHORT = ("ai", "ev", "5g", "ml", "ar", "vr", "mr", "pc")
# Spellings that count as one.
ALIASES = {
    "data centers": "data center", "datacenters": "data center", "ai chips": "ai chip", "semiconductors": "semiconductor",
    "cyber security": "cybersecurity", "electric vehicles": "electric vehicle", "interest rates": "interest rate",
    "treasury yields": "treasury yield", "oil prices": "oil price", "bond yields": "bond yield",
}
# Baskets in order of precedence, and the patterns that put a keyword into them.
BASKETS = {
    "AI Infrastructure": (r"\bai\b", "artificial intelligence", "machine learning", "gpu", "data center", "datacenter", "accelerator", "llm", "generative ai", "agentic"),
    "Semiconductors": ("semiconductor", "chip", "memory", "dram", "nand", "foundry", "wafer", "silicon", "photomask", "eda", "fabless"),
    "Cybersecurity": ("cyber", "ransomware", "zero.trust", "threat", "security", "identity", "firewall", "endpoint"),
    "Cloud Software": ("cloud", "saas", "software", "observability", "database", "crm", "enterprise software", "platform"),
    "Crypto / Digital Assets": ("crypto", "bitcoin", "ethereum", "blockchain", "digital asset", "stablecoin", "token"),
    "Energy Transition": ("renewable", "solar", "wind", "battery", "ev", "electric vehicle", "charging", "hydrogen", "energy transition"),
    "Oil & Gas": ("oil", "natural gas", "lng", "shale", "drilling", "pipeline", "refining", "opec"),
    "Healthcare / Biotech": ("clinical", "fda", "drug", "therapy", "biotech", "pharma", "medical", "oncology", "diabetes", "glp"),
    "Consumer / Retail": ("retail", "consumer", "restaurant", "e.commerce", "grocery", "same.store", "apparel", "travel"),
    "Financials / Credit": ("bank", "credit", "loan", "deposit", "insurance", "asset management", "fintech", "payments", "mortgage"),
    "Defense / Aerospace": ("defense", "aerospace", "missile", "space", "satellite", "army", "navy", "air force", "geopolitics"),
    "Industrial Automation": ("industrial", "automation", "robotics", "manufacturing", "supply chain", "logistics", "equipment"),
    "Housing / Real Estate": ("housing", "real estate", "reit", "construction", "homebuilder", "mortgage rate", "property"),
    "Commodities / Materials": ("copper", "gold", "steel", "aluminum", "lithium", "mining", "chemical", "materials", "commodity"),
    "Macro Rates / Inflation": ("inflation", "treasury", "bond yield", "fed", "interest rate", "recession", "tariff", "cpi", "macro"),
}
# The sector of the first two digits of an industry code.
SIC_SECTORS = {
    "01": "Consumer Staples", "02": "Consumer Staples", "07": "Consumer Staples", "08": "Materials", "09": "Consumer Staples",
    "10": "Materials", "12": "Energy", "13": "Energy", "14": "Materials", "15": "Industrials", "16": "Industrials", "17": "Industrials",
    "20": "Consumer Staples", "21": "Consumer Staples", "22": "Consumer Discretionary", "23": "Consumer Discretionary", "24": "Materials", "25": "Consumer Discretionary", "26": "Materials", "27": "Communication Services", "28": "Healthcare", "29": "Energy",
    "30": "Materials", "31": "Consumer Discretionary", "32": "Materials", "33": "Materials", "34": "Industrials", "35": "Information Technology", "36": "Information Technology", "37": "Industrials", "38": "Healthcare", "39": "Consumer Discretionary",
    "40": "Industrials", "41": "Industrials", "42": "Industrials", "44": "Industrials", "45": "Industrials", "47": "Industrials", "48": "Communication Services", "49": "Utilities",
    "50": "Industrials", "51": "Consumer Staples", "52": "Consumer Discretionary", "53": "Consumer Discretionary", "54": "Consumer Staples", "55": "Consumer Discretionary", "56": "Consumer Discretionary", "57": "Consumer Discretionary", "58": "Consumer Discretionary", "59": "Consumer Discretionary",
    "60": "Financials", "61": "Financials", "62": "Financials", "63": "Financials", "64": "Financials", "65": "Real Estate", "67": "Financials",
    "70": "Consumer Discretionary", "72": "Consumer Discretionary", "73": "Information Technology", "75": "Consumer Discretionary", "78": "Communication Services", "79": "Communication Services",
    "80": "Healthcare", "81": "Industrials", "82": "Consumer Discretionary", "83": "Healthcare", "87": "Industrials",
}


def clean(x: Column) -> Column:
    """Trimmed text; blank counts as missing."""
    return F.nullif(F.btrim(x.cast("string"), F.lit(" \t\n\r\f\x0b")), F.lit(""))


def symbol(x: Column) -> Column:
    """A cleaned ticker in upper case."""
    return F.upper(clean(x))


def to_float(x: Column) -> Column:
    """A number, or null for anything that is none."""
    return clean(x).try_cast("double")


def to_int(x: Column) -> Column:
    """A whole number, cut off after the point."""
    return to_float(x).try_cast("bigint")


def vendor_symbol(x: Column) -> Column:
    """Share classes with a dash, as some vendors write them."""
    return F.translate(x, "/.", "--")


def title(x: Column) -> Column:
    """Letters and digits of a company's name alone, in upper case."""
    return F.regexp_replace(F.upper(F.coalesce(x, F.lit(""))), "[^A-Z0-9]+", "")


def sic_sector(code: Column) -> Column:
    """The sector of an industry code, null if its first two digits have none."""
    pairs = [F.lit(v) for pair in SIC_SECTORS.items() for v in pair]
    return F.try_element_at(F.create_map(*pairs), F.substring(code, 1, 2))


def keyword(x: Column) -> Column:
    """A keyword in lower case, without signs and double spaces, under its usual spelling."""
    s = F.regexp_replace(F.lower(F.btrim(x, F.lit(" \t\n\r\f\x0b"))), r"\s+", " ")
    s = F.regexp_replace(F.replace(s, F.lit("&"), F.lit("and")), "[^a-z0-9+./ -]", "")
    s = F.btrim(F.regexp_replace(s, r"\s+", " "), F.lit(" -"))
    known = F.create_map(*[F.lit(v) for pair in ALIASES.items() for v in pair])
    return F.coalesce(F.try_element_at(known, s), s)


def allowed(k: Column) -> Column:
    """Whether a normalised keyword says something: long enough, not blocked, without a blocked phrase of several words."""
    phrases = "|".join(f"\\Q{p}\\E" for p in BLOCKED if " " in p)
    return (F.length(k) > 0) & ((F.length(k) >= 3) | k.isin(*SHORT)) & ~k.isin(*BLOCKED) & ~k.rlike(phrases)


def basket(k: Column) -> Column:
    """The first basket with a pattern found in a normalised keyword."""
    out = None
    for name, patterns in BASKETS.items():
        hit = k.rlike("|".join(patterns))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def json_list(x: Column) -> Column:
    """The strings of a JSON array; none of a text that is no array."""
    return F.coalesce(F.from_json(x, "array<string>"), F.array().cast("array<string>"))
