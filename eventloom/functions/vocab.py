"""Word lists, patterns and thresholds that results depend on."""

# Fixed values of content types by type code prefix and of importance and region tags.
CONTENT_TYPES = ("US_NEWS", "US_ROBOT", "US_ARTICLE", "US_FLASH", "US_POST", "US_NOTICE")
IMPORTANCE = {"us_high_importance": "high", "us_mid_importance": "mid", "us_low_importance": "low"}
REGIONS = ("NorthAmerica", "Europe", "Asia-Pacific", "Middle-East", "LatinAmerica", "Africa")

# Fixed values of the URL rules.
TRACKING_KEYS = ("cmpid", "fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "mod", "r", "ref", "ref_src")
FEED_PATHS = ("/arc/outboundfeeds/", "/lineup-next/api/", "/market-news")
LIST_KEYS = ("outputtype", "pagenumber", "limit")
SITEMAPS = ("/sitemap", "news-sitemap")

# Fixed values of title tokens.
STOP_WORDS = (
    "a an the of for to in on at as and or with by from is are was were be been its it this that after amid over under up down "
    "new says said report reports stock stocks shares share price prices market markets today week"
).split()
NOISE_TAGS = ("Technical Analysis", "Volatility Metrics", "today_mover", "personal_finance", "Top Gainers", "Top Losers")

# Fixed values of the production macro topics, in order of evaluation.
MACRO_TOPICS = {
    "fed_policy": r"\b(fomc|federal reserve|fed (cuts?|hikes?|holds?|chair|minutes)|powell|interest rate (decision|cut|hike))\b",
    "inflation_jobs": r"\b(cpi|pce|ppi|inflation (data|report|rate)|payrolls|jobs report|unemployment rate)\b",
    "trade_tariff": r"\b(tariffs?|trade (war|deal|talks)|export (controls?|ban|curbs))\b",
    "regulation_policy": r"\b(white house|congress|treasury|sec (approves?|charges?|sues?)|antitrust|doj|ftc|supreme court|executive order|government shutdown)\b",
    "energy_geo": r"\b(opec|crude (oil|prices)|oil prices)\b",
}
# Fixed values that the funnel adds to the macro topics.
FUNNEL_TOPICS = MACRO_TOPICS | {
    "trade_tariff": r"\b(tariffs?|trade (war|deal|talks)|export (controls?|ban|curbs)|anti-dumping)\b",
    "labor_strike": r"\b(strikes?|walkouts?|work stoppage|lockout|uaw|teamsters|union (vote|contract|deal|action))\b",
    "fda_regulatory": r"\b(fda (approv|reject|clear)|advisory committee|complete response letter|biologics license)\b",
    "crypto_structure": r"\b(spot (bitcoin|ether|ethereum) et[fp]|crypto legislation|stablecoin (bill|act)|genius act)\b",
    "gov_program": r"\b(stargate|executive order on ai|chips act|infrastructure (bill|act)|stimulus)\b",
    "geopolitical": r"\b(sanctions?|export ban|military (strike|action)|ceasefire|invasion)\b",
}
MACRO_TAGS = ("CentralBanking", "Monetary Policy", "Trade Agreements", "GeopoliticalConflict", "Regulation", "Policy", "Foreign Policy")

# Fixed values of the hard title rules, in order of evaluation.
HARD_RULES = {
    "data_print": r"\b([1-4]Q|Q[1-4]|[12]H|FY\d{2}|div/shr|est\.|y/y|m/m|q/q|allotted|inventor(y|ies)|loss/share|loss per share|EPS|comp sales|net sales|revenue \$?\d|profit \d|gross margin|NIC \d|shares? (traded|change hands) in a block|yield on|(first|second|third|fourth)[- ]quarter (\d{4} )?(financial |fiscal )?(results|earnings)|reports? (first|second|third|fourth) quarter|financial results)\b",
    "price_move": r"\b(shares? (rise|rose|fall|fell|surge|drop|climb|slip|jump|gain|extend)|stock (rises?|falls?|surges?|drops?|jumps?|surged|fell|jumped|dropped|soared|plunged)|index (rose|fell|rises|falls|gains|drops)|futures (are )?(steady|higher|lower|rise|fall|point)|why .{0,40}(stock|shares) (surged|soared|fell|rose|dropped|jumped|plunged|moved|is (up|down))|(rises?|falls?|drops?|gains?|climbs?|slides?|surged?|soar(s|ed)?|plunged?|tumbled?|jumped|slipped|up|down) (over |more than |nearly |about )?\d+(\.\d+)?%)\b",
    "recap": r"\b(stock market today|market today|pre-?market|after-?hours|most active|week ahead|wall street (brunch|breakfast)|daily (turnover|recap)|top analyst (forecasts|calls)|things to know|what to watch|morning (bid|brief))\b",
    "analyst_rating": r"\b((maintains?|reiterates?|initiates?|resumes?|keeps?) .{0,50}(rating|recommendation|coverage|outperform|underperform|neutral|overweight|underweight|buy|sell|hold)|(is )?(maintained|reiterated|upgraded|downgraded) (at|by)|given '.{0,25}' rating|new analyst forecast|price target (raised|lowered|cut|maintained|to \$)|(fitch|moody'?s( ratings)?|s&p( global( ratings)?)?) .{0,12}(affirms?|assigns?|revises?|places?|withdraws?))\b",
    "routine_pr": r"\b(to (participate|present|speak) (in|at)|presents? at .{0,50}conference|conference call|webcast|fireside chat|investor (day|conference)|annual meeting of (stock|share)holders|resignation of (board|company) secretary|schedules? board meeting|board meeting to (review|approve)|annual general meeting|cash dividend on the way|declares? (quarterly|monthly) (cash )?dividend)\b",
    "holdings_flow": r"\b((buys?|sells?|adds?|trims?|boosts?|cuts?|acquires?) [\d,.]+ shares? of|13[fF] (filing|filer)|lobbying (update|disclosure)|(position|stake) (increased|decreased|boosted|trimmed|raised|lowered))\b",
    "junk_template": r"(\bhoroscope\b|word of the day|\bcrossword\b|\bwordle\b|\brecipe\b|^table:|earnings summary table|\brev nt\$|how much \$?\d+ invested|if you (had )?invested \$?\d|gf (score|value)|-- gf |golden cross|marubozu|\bkdj\b|death cross)",
}
# Fixed values of the robot signals.
SIGNALS = {
    "bearish": r"\bbearish(?:ness| trend)?\b",
    "bollinger_down": r"bollinger bands? expanding downward",
    "bollinger_up": r"bollinger bands? expanding upward",
    "bullish": r"\bbullish(?:ness| trend| momentum)?\b",
    "overbought": r"\boverbought\b",
    "oversold": r"\boversold\b",
    "rsi_overbought": r"\brsi\b.*\boverbought\b|\boverbought\b.*\brsi\b",
    "rsi_oversold": r"\brsi\b.*\boversold\b|\boversold\b.*\brsi\b",
}
# Fixed values of title templates: what is stripped from words, and what counts as a name.
TITLE_STRIP = "(),:;\"'“”|"
NAME_WORD = r"^[A-Z][A-Za-z.&'’\-]*$|^[A-Z0-9.\-]{2,8}$"
# Fixed values of related search: ends of company names, and categories by type of record.
NAME_SUFFIX = r"(?i),?\s+(Inc|Corp|Corporation|Company|Co|Ltd|LLC|plc|Group|Holdings?|Technologies|Therapeutics|Pharmaceuticals|Financial|Services)\.?$"
CATEGORIES = {
    "US_NEWS": "News", "US_FLASH": "Flash", "US_ROBOT": "Robot", "US_POST": "Post", "US_ARTICLE": "Article",
    "report": "Report", "teleconference": "teleconference",
}
PREFERRED_SOURCES = ("reuters", "bloomberg", "wall street journal", "cnbc", "financial times", "marketwatch", "pr newswire", "business wire", "nasdaq", "ainvest wire")
# Fixed value of the filing item line.
ITEM = r"\bItem\s+(\d\.\d{2})\.?\s+([A-Z][A-Za-z0-9 ,;’'\-/&()]+?)(?=\s+(?:On\b|The\b|As\b|In\b|Pursuant\b|\d{4})|[.\n]|$)"

# Fixed thresholds.
DATE_RANGE = ("2000-01-01", "2026-08-01")
ERA_SPLIT = "2023-07-01"
# Fixed value: the index cuts titles to this many characters.
TITLE_CHARS = 400

# Fixed values of the training case.
CASE_SCHEMA = "FinancialPredictionTrainingCase.v4.three_year_event_signal_pack"
CASE_KINDS = ("News", "Flash", "Robot", "Post", "Article", "Report", "teleconference", "AI_search")
SOURCE_KINDS = {
    "US_NEWS": "News", "US_FLASH": "Flash", "US_ROBOT": "Robot", "US_POST": "Post", "US_ARTICLE": "Article",
    "REPORT": "Report", "TELECONFERENCE": "teleconference",
}
LEAKAGE_BOUNDARY = (
    "S0 pre-event market and S1 official event facts are model-visible; S2/S3/S4 prices, follow-on news, analyst reactions and social hindsight "
    "are hidden labels/audit only."
)
RELATION_POLICY = "relation text is visible, but numeric direction/strength labels are not manually assigned"
PRICED, UNPRICED = "priced_and_labeled", "unpriced_weak_candidate_needs_price_panel"
TREATMENT_PRICED = "model-visible relation context; future direction learned from hidden labels"
TREATMENT_UNPRICED = "weak relation candidate; procure price panel before using as supervised target"
TREATMENT_PRICED_CN = "已打价：进入 1D/5D/20D 未来收益标签；方向和强度由标签学习。"
TREATMENT_UNPRICED_CN = "待补价：先作弱关联召回，补齐行情面板后再决定是否进入监督标签。"
RELATION_CN = "事件相关候选"
TRACE_OFFICIAL, TRACE_RELATION = "主事件官方源", "候选标的关系表"
TRAIN_METRICS = ("direction", "return interval", "cross-section rank", "abnormal return vs proxy")
LABEL_BASE = "adjusted close-to-close and tradable open-to-close"
CHANNEL_ROLE = "learnable_channel_not_manual_score"
PRICE_PROVIDER, PRICE_ADJUSTMENT = "Yahoo Finance via yfinance", "auto_adjust=True"
SESSION_SCOPE = "regular_session_09:30_16:00_ET"
