"""Bundled lookup tables: the valid-country list and the country -> languages map.

These are the catalogue job's two reference dimensions.  They are tiny and
bounded (one row per country), so they are safe to broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# These must equal the published lookup files for the cleaning
# job to give the same results.  Valid countries, in file order (122 names).
# ---------------------------------------------------------------------------
VALID_COUNTRIES: tuple[str, ...] = (
    'Russia', 'Paraguay', 'Senegal', 'Sweden', 'Philippines', 'Singapore', 'Malaysia',
    'Turkey', 'Malawi', 'Iraq', 'Germany', 'Cambodia', 'Afghanistan', 'Jordan', 'Sudan',
    'France', 'Greece', 'Sri Lanka', 'Taiwan', 'Algeria', 'Slovakia', 'Argentina',
    'Belgium', 'Angola', 'Qatar', 'Ecuador', 'Albania', 'Finland', 'Ghana', 'Nicaragua',
    'Peru', 'United States', 'India', 'China', 'Bahamas', 'Belarus', 'Kuwait', 'Malta',
    'Somalia', 'Chile', 'Puerto Rico', 'Cayman Islands', 'Soviet Union', 'Croatia',
    'Nigeria', 'Italy', 'Lithuania', 'Norway', 'Spain', 'Cuba', 'Denmark', 'Bangladesh',
    'Iran', 'Ireland', 'Liechtenstein', 'Thailand', 'Morocco', 'Panama', 'Hong Kong',
    'Venezuela', 'Ukraine', 'Israel', 'Iceland', 'West Germany', 'East Germany',
    'South Korea', 'Palestine', 'Cyprus', 'Uruguay', 'Mexico', 'Zimbabwe', 'Georgia',
    'Montenegro', 'Indonesia', 'Guatemala', 'Mongolia', 'Azerbaijan', 'Armenia',
    'Syria', 'Saudi Arabia', 'Uganda', 'Namibia', 'Switzerland', 'Ethiopia', 'Latvia',
    'Jamaica', 'United Arab Emirates', 'Canada', 'Samoa', 'Czech Republic',
    'Mozambique', 'Brazil', 'Kenya', 'Lebanon', 'Slovenia', 'Dominican Republic',
    'Japan', 'Botswana', 'Luxembourg', 'New Zealand', 'Poland', 'Portugal', 'Australia',
    'Cameroon', 'Romania', 'Bulgaria', 'Nepal', 'Austria', 'Egypt', 'Kazakhstan',
    'Serbia', 'South Africa', 'Burkina Faso', 'Bermuda', 'Colombia', 'Hungary',
    'Pakistan', 'Vatican City', 'Mauritius', 'United Kingdom', 'Vietnam', 'Netherlands',
)

# Country -> languages records, in file order (120 records;
# Ecuador appears twice, as in the published file).
COUNTRY_LANGUAGES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ('Russia', ('Russian',)),
    ('Paraguay', ('Spanish', 'Guarani')),
    ('Senegal', ('French',)),
    ('Sweden', ('Swedish',)),
    ('Philippines', ('Filipino', 'English')),
    ('Singapore', ('English', 'Malay', 'Mandarin', 'Tamil')),
    ('Malaysia', ('Malay',)),
    ('Turkey', ('Turkish',)),
    ('Malawi', ('English', 'Chichewa')),
    ('Iraq', ('Arabic', 'Kurdish')),
    ('Germany', ('German',)),
    ('Cambodia', ('Khmer',)),
    ('Afghanistan', ('Dari', 'Pashto')),
    ('Jordan', ('Arabic',)),
    ('Sudan', ('Arabic', 'English')),
    ('France', ('French',)),
    ('Greece', ('Greek',)),
    ('Sri Lanka', ('Sinhala', 'Tamil')),
    ('Taiwan', ('Mandarin',)),
    ('Algeria', ('Arabic', 'Berber')),
    ('Slovakia', ('Slovak',)),
    ('Argentina', ('Spanish',)),
    ('Belgium', ('Dutch', 'French', 'German')),
    ('Angola', ('Portuguese',)),
    ('Qatar', ('Arabic',)),
    ('Ecuador', ('Spanish',)),
    ('Albania', ('Albanian',)),
    ('Finland', ('Finnish', 'Swedish')),
    ('Ghana', ('English',)),
    ('Nicaragua', ('Spanish',)),
    ('Peru', ('Spanish',)),
    ('United States', ('English',)),
    ('India', ('Hindi', 'English')),
    ('China', ('Mandarin',)),
    ('Bahamas', ('English',)),
    ('Belarus', ('Belarusian', 'Russian')),
    ('Kuwait', ('Arabic',)),
    ('Malta', ('Maltese', 'English')),
    ('Somalia', ('Somali', 'Arabic')),
    ('Chile', ('Spanish',)),
    ('Puerto Rico', ('Spanish', 'English')),
    ('Cayman Islands', ('English',)),
    ('Soviet Union', ('Russian',)),
    ('Croatia', ('Croatian',)),
    ('Nigeria', ('English',)),
    ('Italy', ('Italian',)),
    ('Lithuania', ('Lithuanian',)),
    ('Norway', ('Norwegian',)),
    ('Spain', ('Spanish',)),
    ('Cuba', ('Spanish',)),
    ('Denmark', ('Danish',)),
    ('Bangladesh', ('Bengali',)),
    ('Iran', ('Persian',)),
    ('Ireland', ('English', 'Irish')),
    ('Liechtenstein', ('German',)),
    ('Thailand', ('Thai',)),
    ('Morocco', ('Arabic', 'Berber')),
    ('Panama', ('Spanish',)),
    ('Hong Kong', ('Cantonese', 'English')),
    ('Venezuela', ('Spanish',)),
    ('Ukraine', ('Ukrainian',)),
    ('Israel', ('Hebrew',)),
    ('Iceland', ('Icelandic',)),
    ('West Germany', ('German',)),
    ('East Germany', ('German',)),
    ('South Korea', ('Korean',)),
    ('Palestine', ('Arabic',)),
    ('Cyprus', ('Greek', 'Turkish')),
    ('Uruguay', ('Spanish',)),
    ('Mexico', ('Spanish',)),
    ('Zimbabwe', ('English', 'Shona', 'Sindebele')),
    ('Georgia', ('Georgian',)),
    ('Montenegro', ('Montenegrin',)),
    ('Indonesia', ('Indonesian',)),
    ('Guatemala', ('Spanish',)),
    ('Mongolia', ('Mongolian',)),
    ('Azerbaijan', ('Azerbaijani',)),
    ('Armenia', ('Armenian',)),
    ('Syria', ('Arabic',)),
    ('Saudi Arabia', ('Arabic',)),
    ('Uganda', ('English', 'Swahili')),
    ('Namibia', ('English',)),
    ('Switzerland', ('German', 'French', 'Italian', 'Romansh')),
    ('Ethiopia', ('Amharic',)),
    ('Latvia', ('Latvian',)),
    ('Jamaica', ('English',)),
    ('United Arab Emirates', ('Arabic',)),
    ('Canada', ('English', 'French')),
    ('Samoa', ('Samoan', 'English')),
    ('Czech Republic', ('Czech',)),
    ('Mozambique', ('Portuguese',)),
    ('Brazil', ('Portuguese',)),
    ('Kenya', ('English', 'Swahili')),
    ('Lebanon', ('Arabic',)),
    ('Slovenia', ('Slovene',)),
    ('Dominican Republic', ('Spanish',)),
    ('Japan', ('Japanese',)),
    ('Botswana', ('English', 'Setswana')),
    ('Luxembourg', ('Luxembourgish', 'French', 'German')),
    ('New Zealand', ('English', 'Māori')),
    ('Poland', ('Polish',)),
    ('Portugal', ('Portuguese',)),
    ('Australia', ('English',)),
    ('Cameroon', ('English', 'French')),
    ('Romania', ('Romanian',)),
    ('Bulgaria', ('Bulgarian',)),
    ('Nepal', ('Nepali',)),
    ('Austria', ('German',)),
    ('Egypt', ('Arabic',)),
    ('Kazakhstan', ('Kazakh', 'Russian')),
    ('Serbia', ('Serbian',)),
    ('South Africa', ('Afrikaans', 'English', 'Zulu', 'Xhosa')),
    ('Burkina Faso', ('French',)),
    ('Bermuda', ('English',)),
    ('Colombia', ('Spanish',)),
    ('Costa Rica', ('Spanish',)),
    ('El Salvador', ('Spanish',)),
    ('Ecuador', ('Spanish',)),
    ('Belize', ('English',)),
    ('Honduras', ('Spanish',)),
)


def valid_countries_df(spark: SparkSession) -> DataFrame:
    """The bundled valid-country list as a one-column ``country`` DataFrame."""
    return spark.createDataFrame([(c,) for c in VALID_COUNTRIES], "country string")


def language_map_df(spark: SparkSession) -> DataFrame:
    """The bundled map in its published array-of-records shape:
    ``country string, Languages array<string>`` (duplicate keys kept)."""
    return spark.createDataFrame(
        [(c, list(langs)) for c, langs in COUNTRY_LANGUAGES],
        "country string, Languages array<string>",
    )
