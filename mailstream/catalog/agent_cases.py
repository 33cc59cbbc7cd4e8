"""User-agent texts with hand-written answers; commas are escaped as on the wire."""

from __future__ import annotations

# Text, then browser and version, system and version, device family, brand
# and model, type, touch.  The first eight were the first fixture.
AGENT_CASES: tuple[tuple[str, tuple], ...] = (
    (
        "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/114.0.5735.199 Safari/537.36",
        ("Chrome", "114.0.5735", "Windows", "10", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Version/16.5 Mobile/15E148 Safari/604.1",
        ("Mobile Safari", "16.5", "iOS", "16.5", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPad; CPU OS 15_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Version/15.2 Mobile/15E148 Safari/604.1",
        ("Mobile Safari", "15.2", "iOS", "15.2", "iPad", "Apple", "iPad", "tablet", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 13; SM-S901B) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/112.0.0.0 Mobile Safari/537.36",
        ("Chrome Mobile", "112.0.0", "Android", "13", "Samsung SM-S901B", "Samsung", "SM-S901B", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0",
        ("Firefox", "115.0", "Linux", "", "Other", None, None, "pc", 0),
    ),
    (
        "curl/8.0",
        ("curl", "8.0", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML||| like Gecko) Version/16.5 Safari/605.1.15",
        ("Safari", "16.5", "Mac OS X", "10.15.7", "Mac", "Apple", "Mac", "pc", 0),
    ),
    (
        "",
        ("Other", "", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/91.0.4472.124 Safari/537.36 Edg/91.0.864.59",
        ("Edge", "91.0.864", "Windows", "7", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/64.0.3282.140 Safari/537.36 Edge/18.17763",
        ("Edge", "18.17763", "Windows", "10", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 6.3; Win64; x64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/100.0.4896.60 Safari/537.36 OPR/86.0.4363.23",
        ("Opera", "86.0.4363", "Windows", "8.1", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 6.2; Win64; x64; Touch; Trident/7.0; rv:11.0) like Gecko",
        ("IE", "11.0", "Windows", "8", "Other", None, None, "pc", 1),
    ),
    (
        "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.0; Trident/5.0)",
        ("IE", "9.0", "Windows", "Vista", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Linux; Android 10; SAMSUNG SM-T510) AppleWebKit/537.36 (KHTML||| like Gecko) SamsungBrowser/14.2 Chrome/87.0.4280.141 Safari/537.36",
        ("Samsung Internet", "14.2", "Android", "10", "Samsung SM-T510", "Samsung", "SM-T510", "tablet", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 12; Pixel 6 Build/SD1A.210817.023; wv) AppleWebKit/537.36 (KHTML||| like Gecko) Version/4.0 Chrome/94.0.4606.71 Mobile Safari/537.36",
        ("Chrome Mobile WebView", "94.0.4606", "Android", "12", "Pixel 6", "Google", "Pixel 6", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 10; K) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/124.0.0.0 Mobile Safari/537.36",
        ("Chrome Mobile", "124.0.0", "Android", "10", "K", "Generic_Android", "K", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 9; Redmi Note 8) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/89.0.4389.72 Mobile Safari/537.36",
        ("Chrome Mobile", "89.0.4389", "Android", "9", "XiaoMi Redmi Note 8", "XiaoMi", "Redmi Note 8", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Android 13; Mobile; rv:109.0) Gecko/114.0 Firefox/114.0",
        ("Firefox Mobile", "114.0", "Android", "13", "Generic Smartphone", "Generic", "Smartphone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 15_6_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) CriOS/112.0.5615.46 Mobile/15E148 Safari/604.1",
        ("Chrome Mobile iOS", "112.0.5615", "iOS", "15.6.1", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 16_3 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Mobile/15E148",
        ("Mobile Safari UI/WKWebView", "16.3", "iOS", "16.3", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:102.0) Gecko/20100101 Firefox/102.0",
        ("Firefox", "102.0", "Ubuntu", "", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/114.0.0.0 Safari/537.36",
        ("Chrome", "114.0.0", "Chrome OS", "14541.0.0", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
        ("Googlebot", "2.1", "Other", "", "Spider", "Spider", "Desktop", "other", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 5.1; rv:11.0) Gecko Firefox/11.0 (via ggpht.com GoogleImageProxy)",
        ("GmailImageProxy", "", "Windows", "XP", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/4.0 (compatible; MSIE 7.0; Windows NT 6.1; Trident/7.0; Microsoft Outlook 14.0.7166; MSOffice 14)",
        ("Outlook", "2010", "Windows", "7", "Other", None, None, "pc", 0),
    ),
    (
        "python-requests/2.31.0",
        ("Python Requests", "2.31.0", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML||| like Gecko)",
        ("Apple Mail", "605.1.15", "Mac OS X", "10.15.7", "Mac", "Apple", "Mac", "pc", 0),
    ),
    (
        "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML||| like Gecko) HeadlessChrome/119.0.6045.105 Safari/537.36",
        ("HeadlessChrome", "119.0.6045", "Linux", "", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Mobile; Windows Phone 8.1; Android 4.0; ARM; Trident/7.0; Touch; rv:11.0; IEMobile/11.0; NOKIA; Lumia 520) like iPhone OS 7_0_3",
        ("IE Mobile", "11.0", "Windows Phone", "8.1", "Other", None, None, "mobile", 1),
    ),
    (
        "Mozilla/5.0 (compatible; MSIE 9.0; Windows Phone OS 7.5; Trident/5.0; IEMobile/9.0)",
        ("IE Mobile", "9.0", "Windows Phone", "7.5", "Other", None, None, "mobile", 1),
    ),
    (
        "Mozilla/5.0 (BlackBerry; U; BlackBerry 9900; en) AppleWebKit/534.11+ (KHTML||| like Gecko) Version/7.1.0.346 Mobile Safari/534.11+",
        ("BlackBerry WebKit", "7.1.0", "BlackBerry OS", "7.1.0", "Other", None, None, "mobile", 0),
    ),
    (
        "Mozilla/5.0 (BB10; Touch) AppleWebKit/537.10+ (KHTML||| like Gecko) Version/10.0.9.2372 Mobile Safari/537.10+",
        ("Mobile Safari", "10.0.9", "BlackBerry OS", "10.0.9", "Other", None, None, "mobile", 0),
    ),
    (
        "Mozilla/5.0 (iPod touch; CPU iPhone OS 12_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Version/12.0 Mobile/15A372 Safari/604.1",
        ("Mobile Safari", "12.0", "iOS", "12.0", "iPod", "Apple", "iPod", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPad; CPU OS 13_4 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Mobile/15E148",
        ("Mobile Safari UI/WKWebView", "13.4", "iOS", "13.4", "iPad", "Apple", "iPad", "tablet", 1),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 14_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) FxiOS/29.0 Mobile/15E148 Safari/605.1.15",
        ("Firefox iOS", "29.0", "iOS", "14.2", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 14_4 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) EdgiOS/46.2.0 Mobile/15E148 Safari/605.1.15",
        ("Edge Mobile", "46.2.0", "iOS", "14.4", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 10; ONEPLUS A6003) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/90.0.4430.82 Mobile Safari/537.36 EdgA/46.3.4.5155",
        ("Edge Mobile", "46.3.4", "Android", "10", "OnePlus ONEPLUS A6003", "OnePlus", "ONEPLUS A6003", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Linux; Android 9; moto g(7)) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/91.0.4472.77 Mobile Safari/537.36 OPR/63.3.3216",
        ("Opera Mobile", "63.3.3216", "Android", "9", "Motorola moto g(7", "Motorola", "moto g(7", "mobile", 1),
    ),
    (
        "Opera/9.80 (J2ME/MIDP; Opera Mini/7.1.32052/29.3709; U; en) Presto/2.8.119 Version/11.10",
        ("Opera Mini", "7.1.32052", "Other", "", "Other", None, None, "mobile", 0),
    ),
    (
        "Opera/9.80 (Windows NT 6.1; WOW64) Presto/2.12.388 Version/12.18",
        ("Opera", "12.18", "Windows", "7", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/96.0.4664.45 YaBrowser/22.1.0 Safari/537.36",
        ("Yandex Browser", "22.1.0", "Windows", "10", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/108.0.0.0 Safari/537.36 Vivaldi/5.6.2867",
        ("Vivaldi", "5.6.2867", "Windows", "10", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (Linux; U; Android 8.1.0; en-US; Redmi 5 Plus Build/OPM1) AppleWebKit/537.36 (KHTML||| like Gecko) Version/4.0 UCBrowser/12.11.8 Mobile Safari/537.36",
        ("UC Browser", "12.11.8", "Android", "8.1.0", "XiaoMi Redmi 5 Plus", "XiaoMi", "Redmi 5 Plus", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (Linux; U; Android 4.0.3; en-us; Nexus S Build/IML74K) AppleWebKit/534.30 (KHTML||| like Gecko) Version/4.0 Mobile Safari/534.30",
        ("Android", "4.0.3", "Android", "4.0.3", "Nexus S", "Google", "Nexus S", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:94.0) Gecko/20100101 Thunderbird/91.3.0",
        ("Thunderbird", "91.3.0", "Fedora", "", "Other", None, None, "pc", 0),
    ),
    (
        "Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)",
        ("bingbot", "2.0", "Other", "", "Spider", "Spider", "Desktop", "other", 0),
    ),
    (
        "Mozilla/5.0 (compatible; YandexBot/3.0; +http://yandex.com/bots)",
        ("YandexBot", "3.0", "Other", "", "Spider", "Spider", "Desktop", "other", 0),
    ),
    (
        "facebookexternalhit/1.1 (+http://www.facebook.com/externalhit_uatext.php)",
        ("FacebookBot", "1.1", "Other", "", "Spider", "Spider", "Desktop", "other", 0),
    ),
    (
        "Twitterbot/1.0",
        ("Twitterbot", "1.0", "Other", "", "Spider", "Spider", "Desktop", "other", 0),
    ),
    (
        "YahooMailProxy; https://help.yahoo.com/kb/yahoo-mail-proxy-SLN28749.html",
        ("YahooMailProxy", "", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Wget/1.21.2",
        ("Wget", "1.21.2", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "okhttp/4.9.3",
        ("okhttp", "4.9.3", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Go-http-client/1.1",
        ("Go-http-client", "1.1", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Apache-HttpClient/4.5.13 (Java/11.0.13)",
        ("Apache-HttpClient", "4.5.13", "Other", "", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (X11; FreeBSD amd64; rv:100.0) Gecko/20100101 Firefox/100.0",
        ("Firefox", "100.0", "FreeBSD", "", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (Linux; Tizen 2.3; SAMSUNG SM-Z130H) AppleWebKit/537.3 (KHTML||| like Gecko) SamsungBrowser/1.0 Mobile Safari/537.3",
        ("Samsung Internet", "1.0", "Tizen", "2.3", "Other", None, None, "other", 0),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 15_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Mobile/15E148 Instagram 210.0.0.13.71",
        ("Instagram", "210.0.0", "iOS", "15.0", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
    (
        "Mozilla/5.0 (iPhone; CPU iPhone OS 16_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML||| like Gecko) Mobile/20B82 [FBAN/FBIOS;FBAV/390.1.0.37]",
        ("Facebook", "390.1.0", "iOS", "16.1", "iPhone", "Apple", "iPhone", "mobile", 1),
    ),
)

# What a missing text gives.
MISSING_AGENT = (*(None,) * 7, "other", 2)
