"""User-agent text to browser, operating system and device columns.

The rules are tables that become literal arrays and maps, so the generated code
stays the same size however many rules there are.  A text is cut into words once.
The first rule of a table whose word, and whose variant if it has one, are among them
is taken.  The tables are a documented subset of what a full parser database knows;
`rules_from_json` reads more from a file, for the reports and `parse_user_agent`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Device:
    family: str
    brand: str
    model: str


@dataclass(frozen=True)
class Rule:
    """What a word, or a word and a variant, says.

    `anchor` is the text right before the version, empty if there is none.
    `kind` is the device type, `android` where that depends on the rest of the text.
    """

    word: str
    family: str
    anchor: str = ""
    variant: str = ""
    kind: str = ""
    touch: bool = False
    device: Device | None = None


# Types of a device and of what a lookup gives for a rule.
DEVICE_TYPE = "struct<family: string, brand: string, model: string>"
RULE_TYPE = (
    "struct<family: string, anchor: string, kind: string, touch: boolean, "
    f"device: {DEVICE_TYPE}>"
)

# What a word is, and a version of at most three parts.  Every text
# ends with an empty word, which the last rule of each table matches.
WORD = "[A-Za-z0-9_-]+|$"
VERSION = r"^(?:OS )?(\d+(?:[._]\d+){0,2})"

# Devices with a known name.
SPIDER = Device("Spider", "Spider", "Desktop")
SPIDER_PHONE = Device("Spider", "Spider", "Smartphone")
IPHONE = Device("iPhone", "Apple", "iPhone")
IPAD = Device("iPad", "Apple", "iPad")
IPOD = Device("iPod", "Apple", "iPod")
MAC = Device("Mac", "Apple", "Mac")

# Browsers, first match wins.
BROWSERS: tuple[Rule, ...] = (
    Rule("Googlebot", "Googlebot", "Googlebot/", variant="Android", device=SPIDER_PHONE),
    Rule("Googlebot", "Googlebot", "Googlebot/", device=SPIDER),
    Rule("bingbot", "bingbot", "bingbot/", variant="Android", device=SPIDER_PHONE),
    Rule("bingbot", "bingbot", "bingbot/", device=SPIDER),
    Rule("YandexBot", "YandexBot", "YandexBot/", variant="iPhone", device=SPIDER_PHONE),
    Rule("YandexBot", "YandexBot", "YandexBot/", device=SPIDER),
    Rule("facebookexternalhit", "FacebookBot", "facebookexternalhit/", device=SPIDER),
    Rule("Twitterbot", "Twitterbot", "Twitterbot/", device=SPIDER),
    Rule("GoogleImageProxy", "GmailImageProxy"),
    Rule("YahooMailProxy", "YahooMailProxy"),
    Rule("Thunderbird", "Thunderbird", "Thunderbird/"),
    Rule("MSOffice", "Outlook", "MSOffice "),
    Rule("FBAV", "Facebook", "FBAV/"),
    Rule("Instagram", "Instagram", "Instagram "),
    Rule("EdgA", "Edge Mobile", "EdgA/"),
    Rule("EdgiOS", "Edge Mobile", "EdgiOS/"),
    Rule("Edge", "Edge Mobile", "Edge/", variant="Phone"),
    Rule("Edge", "Edge", "Edge/"),
    Rule("Edg", "Edge", "Edg/"),
    Rule("OPR", "Opera Mobile", "OPR/", variant="Mobile", kind="mobile"),
    Rule("OPR", "Opera", "OPR/"),
    Rule("Opera", "Opera Mini", "Opera Mini/", variant="Mini", kind="mobile"),
    Rule("Opera", "Opera", "Version/"),
    Rule("SamsungBrowser", "Samsung Internet", "SamsungBrowser/"),
    Rule("UCBrowser", "UC Browser", "UCBrowser/"),
    Rule("YaBrowser", "Yandex Browser", "YaBrowser/"),
    Rule("Vivaldi", "Vivaldi", "Vivaldi/"),
    Rule("FxiOS", "Firefox iOS", "FxiOS/"),
    Rule("Firefox", "Firefox Mobile", "Firefox/", variant="Mobile"),
    Rule("Firefox", "Firefox Mobile", "Firefox/", variant="Tablet"),
    Rule("Firefox", "Firefox", "Firefox/"),
    Rule("CriOS", "Chrome Mobile iOS", "CriOS/", kind="mobile"),
    Rule("Chrome", "Chrome Mobile WebView", "Chrome/", variant="wv", kind="mobile"),
    Rule("Chrome", "Chrome Mobile", "Chrome/", variant="Mobile", kind="mobile"),
    Rule("Chrome", "Chrome", "Chrome/"),
    Rule("HeadlessChrome", "HeadlessChrome", "HeadlessChrome/"),
    Rule("IEMobile", "IE Mobile", "IEMobile/", kind="mobile"),
    Rule("MSIE", "IE", "MSIE "),
    Rule("Trident", "IE", "rv:"),
    Rule("BlackBerry", "BlackBerry WebKit", "Version/", kind="mobile"),
    Rule("Version", "Android", "Android ", variant="Android"),
    Rule("Version", "Mobile Safari", "Version/", variant="Mobile"),
    Rule("Version", "Safari", "Version/", variant="Safari"),
    Rule("AppleWebKit", "Mobile Safari UI/WKWebView", "iPhone OS ", variant="iPhone"),
    Rule("AppleWebKit", "Mobile Safari UI/WKWebView", "CPU OS ", variant="iPad"),
    Rule("AppleWebKit", "Apple Mail", "AppleWebKit/", variant="Macintosh"),
    Rule("curl", "curl", "curl/"),
    Rule("Wget", "Wget", "Wget/"),
    Rule("python-requests", "Python Requests", "python-requests/"),
    Rule("okhttp", "okhttp", "okhttp/"),
    Rule("Go-http-client", "Go-http-client", "Go-http-client/"),
    Rule("Apache-HttpClient", "Apache-HttpClient", "Apache-HttpClient/"),
    Rule("", "Other"),
)

# Operating systems, first match wins.
SYSTEMS: tuple[Rule, ...] = (
    Rule("Windows", "Windows Phone", "Windows Phone ", variant="Phone", kind="mobile", touch=True),
    Rule("Windows", "Windows", "Windows NT ", variant="ARM", kind="tablet", touch=True),
    Rule("Windows", "Windows", "Windows NT ", kind="pc"),
    Rule("Android", "Android", "Android ", kind="android", touch=True),
    Rule("iPod", "iOS", "iPhone OS ", kind="mobile", touch=True, device=IPOD),
    Rule("iPhone", "iOS", "iPhone OS ", kind="mobile", touch=True, device=IPHONE),
    Rule("iPad", "iOS", "CPU OS ", kind="tablet", touch=True, device=IPAD),
    Rule("Macintosh", "Mac OS X", "Mac OS X ", kind="pc", device=MAC),
    Rule("CrOS", "Chrome OS", "CrOS x86_64 ", variant="x86_64", kind="pc"),
    Rule("CrOS", "Chrome OS", "CrOS aarch64 ", variant="aarch64", kind="pc"),
    Rule("CrOS", "Chrome OS", "CrOS armv7l ", variant="armv7l", kind="pc"),
    Rule("CrOS", "Chrome OS", kind="pc"),
    Rule("BB10", "BlackBerry OS", "Version/", kind="mobile"),
    Rule("BlackBerry", "BlackBerry OS", "Version/", kind="mobile"),
    Rule("Tizen", "Tizen", "Tizen "),
    Rule("Ubuntu", "Ubuntu", "Ubuntu/", variant="X11", kind="pc"),
    Rule("Ubuntu", "Ubuntu", "Ubuntu/"),
    Rule("Fedora", "Fedora", "Fedora/", variant="X11", kind="pc"),
    Rule("Fedora", "Fedora", "Fedora/"),
    Rule("FreeBSD", "FreeBSD"),
    Rule("Linux", "Linux", variant="X11", kind="pc"),
    Rule("Linux", "Linux"),
    Rule("", "Other"),
)

# Versions that go by another name.
VERSION_NAMES: dict[str, str] = {
    "Outlook 12": "2007",
    "Outlook 14": "2010",
    "Outlook 15": "2013",
    "Outlook 16": "2016",
    "Windows 5.0": "2000",
    "Windows 5.1": "XP",
    "Windows 5.2": "XP",
    "Windows 6.0": "Vista",
    "Windows 6.1": "7",
    "Windows 6.2": "8",
    "Windows 6.3": "8.1",
    "Windows 10.0": "10",
}

# The model of an Android device stands after the system version;
# its first letters tell the brand and the word the family starts with.
ANDROID_MODEL = r"Android [0-9.]+; (?:[a-z]{2}-[A-Za-z]{2}; )?(?:SAMSUNG )?([^;)]+?)(?: Build|[;)])"
ANDROID_BRANDS: dict[str, tuple[str, str]] = {
    "SM-": ("Samsung", "Samsung "),
    "GT-": ("Samsung", "Samsung "),
    "Pixel": ("Google", ""),
    "Nexus": ("Google", ""),
    "Redmi": ("XiaoMi", "XiaoMi "),
    "POCO": ("XiaoMi", "XiaoMi "),
    "ONEPLUS": ("OnePlus", "OnePlus "),
    "moto": ("Motorola", "Motorola "),
    "HUAWEI": ("Huawei", ""),
    "Nokia": ("Nokia", ""),
}
OTHER_ANDROID_BRAND = "Generic_Android"
GENERIC_ANDROID = {"Mobile": "Smartphone", "Tablet": "Tablet"}

# The nine fields, in output order.
FIELDS = (
    "browser_family",
    "browser_version",
    "os_family",
    "os_version",
    "device_family",
    "device_brand",
    "device_model",
    "device_type",
    "device_touch_capable",
)


def unescape_commas(text: Column | str) -> Column:
    """Undo the upstream escape of commas inside a user agent."""
    return F.replace(text, F.lit("|||"), F.lit(","))


def text_words(text: Column) -> Column:
    """The words of a text; NULL for NULL."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _array(values: Sequence[str]) -> Column:
    return F.lit(list(values))


def _map(values: Mapping[str, object], value_type: str = "string") -> Column:
    """A literal map, passed as one text that the optimizer folds to a constant."""
    return F.from_json(F.lit(json.dumps(values)), f"map<string, {value_type}>")


def _first_present(candidates: Column, words: Column) -> Column:
    return F.get(F.array_intersect(candidates, words), F.lit(0))


def _key(rule: Rule) -> str:
    return f"{rule.word}+{rule.variant}" if rule.variant else rule.word


def rule_key(words: Column, rules: Sequence[Rule]) -> Column:
    """Key of the first rule that the words of a text match; NULL without a text.

    Only the table's words that the text has are looked at, with the variants of each.
    """
    variants: dict[str, list[str]] = {}
    for rule in rules:
        if rule.variant:
            variants.setdefault(rule.word, []).append(rule.variant)
    present = F.array_intersect(
        _array(list(dict.fromkeys(rule.word for rule in rules))), words
    )

    def keys(word: Column) -> Column:
        known = F.try_element_at(_map(variants, "array<string>"), word)
        found = F.array_intersect(F.coalesce(known, F.array().cast("array<string>")), words)
        refined = F.transform(found, lambda variant: F.concat(word, F.lit("+"), variant))
        return F.concat(refined, F.array(word))

    in_order = _array(list(dict.fromkeys(_key(rule) for rule in rules)))
    return _first_present(in_order, F.flatten(F.transform(present, keys)))


def rules_from_json(path: str) -> tuple[tuple[Rule, ...], tuple[Rule, ...]]:
    """Browser and system tables: the rules of a file before the built-in ones.

    The file holds `{"browsers": [...], "systems": [...]}`, each rule an object with the
    fields of `Rule`; `device` is an object with those of `Device`.
    """

    def rule(values: dict) -> Rule:
        device = values.pop("device", None)
        return Rule(**values, device=Device(**device) if device else None)

    with open(path, encoding="utf-8") as file:
        tables = json.load(file)
    browsers, systems = (
        tuple(rule(dict(values)) for values in tables.get(name, []))
        for name in ("browsers", "systems")
    )
    return (*browsers, *BROWSERS), (*systems, *SYSTEMS)


def rule_struct(key: Column, rules: Sequence[Rule]) -> Column:
    """All values of the rule with this key as a struct, NULL without a text."""
    # Of rules with the same word and variant the first one counts.
    values = {_key(rule): asdict(rule) for rule in reversed(rules)}
    return F.try_element_at(_map(values, RULE_TYPE), key)


def version(rule: Column, text: Column) -> Column:
    """Version right after the last anchor of the rule; empty when there is none."""
    after = F.call_function("substring_index", text, rule["anchor"], F.lit(-1))
    return F.translate(F.regexp_extract(after, VERSION, 1), "_", ".")


def version_name(rule: Column, number: Column) -> Column:
    """The name a version goes by, else its number."""
    name = F.try_element_at(_map(VERSION_NAMES), F.concat(rule["family"], F.lit(" "), number))
    return F.coalesce(name, number)


def android_model(text: Column) -> Column:
    """What an Android text says about its model; empty when it says nothing."""
    return F.regexp_extract(text, ANDROID_MODEL, 1)


def android_brand(model: Column) -> Column:
    """Struct of brand and family prefix by the first letters of a model."""
    letters = F.regexp_extract(model, f"^({'|'.join(ANDROID_BRANDS)})", 1)
    values = {
        prefix: {"brand": brand, "start": start}
        for prefix, (brand, start) in ANDROID_BRANDS.items()
    }
    return F.try_element_at(_map(values, "struct<brand: string, start: string>"), letters)


def android_generic(model: Column) -> Column:
    """Device struct of a text that names the size, not the model."""
    values = {
        word: asdict(Device(f"Generic {size}", "Generic", size))
        for word, size in GENERIC_ANDROID.items()
    }
    return F.try_element_at(_map(values, DEVICE_TYPE), model)


def device(text: Column, browser: Column, system: Column, model: Column) -> Column:
    """Struct of family, brand and model.

    A crawler is known by its browser rule, other known devices by their system
    rule, an Android device by its model; the rest is `Other`.  NULL without a text.
    """
    brand, generic = android_brand(model), android_generic(model)
    nothing = F.lit(None).cast("string")
    android = F.struct(
        F.concat(F.coalesce(brand["start"], F.lit("")), model).alias("family"),
        F.coalesce(brand["brand"], F.lit(OTHER_ANDROID_BRAND)).alias("brand"),
        model.alias("model"),
    )
    other = F.struct(
        F.lit("Other").alias("family"), nothing.alias("brand"), nothing.alias("model")
    )
    return F.coalesce(
        browser["device"],
        system["device"],
        generic,
        F.when(model != "", android),
        F.when(text.isNotNull(), other),
    )


def device_type(text: Column, browser: Column, system: Column, model: Column) -> Column:
    """`mobile`, else `tablet`, else `pc`, else `other` (also for NULL).

    `browser` and `system` are rule structs.
    """
    android = system["kind"] == "android"
    android_tablet = (
        android & ~text.contains("Mobile Safari") & (browser["family"] != "Firefox Mobile")
    )
    mobile = (
        (browser["kind"] == "mobile")
        | (system["kind"] == "mobile")
        | (android & ~android_tablet)
        | (model == "Mobile")
        | text.contains("MIDP")
    )
    return (
        F.when(mobile, "mobile")
        .when(android_tablet, "tablet")
        .when(system["kind"].isin("tablet", "pc"), system["kind"])
        .otherwise("other")
    )


def is_touch(text: Column, system: Column, system_version: Column) -> Column:
    """Whether the device has a touch screen; NULL when there is no user agent."""
    windows_8 = (system["family"] == "Windows") & system_version.startswith("8")
    return system["touch"] | (windows_8 & text.contains("Touch"))


def touch_flag(touch: Column) -> Column:
    """1 for true, 0 for false, 2 for unknown."""
    return F.when(touch, F.lit(1)).when(~touch, F.lit(0)).otherwise(F.lit(2))
