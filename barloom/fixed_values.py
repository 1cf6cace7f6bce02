"""Names, labels, dates and periods that results must agree on.

Nothing here is computed. Every list is in its published order.
"""

from __future__ import annotations

# ---- indicator parameters -------------------------------------------------
SMA_PERIODS = (5, 10, 20, 40, 60, 120, 240)
STOCH_PERIODS = (9, 3, 3)
MACD_PERIODS = (12, 26, 9)
BBANDS_PERIOD = 20
BBANDS_WIDTH = 2.1
RSI_PERIOD = 14
OVERSOLD_LEVEL = 20
OVERBOUGHT_LEVEL = 80
RSI_LEVELS = (20, 80)
MACD_CROSS_GAP = 0.1
FORWARD_HORIZONS = (5, 10, 20)

# ---- screening and polling ------------------------------------------------
RECENT_DAYS = 3
POSITIVE_DAYS = 3
CODES_PER_BATCH = 50
SESSION_OPEN = "09:00"
SESSION_CLOSE = "13:40"
POLL_INTERVAL = "5 minutes"

# ---- filing deadlines, month-day, by reporting period ---------------------
GENERAL_DEADLINES = {
    "q1": "05-15",
    "q2": "08-14",
    "q3": "11-14",
    "annual": "03-31",
}
FINANCIAL_DEADLINES = {
    "q1": "05-30",
    "q2": "08-31",
    "q3": "11-29",
    "annual": "03-31",
}

# ---- markers and patterns -------------------------------------------------
MISSING_MARKER = "-"
TOTAL_LABEL = "合計"
CODE_HEADING = "公司代號"
WEEKDAY_SIGNS = "[()一二三四五六日]"
PAREN_WORD = r"\((\w+)\)"
ROC_OFFSET = 1911
ROC_THRESHOLD = 1990
QUOTE_FIELDS = ("c", "n", "z", "tv", "v", "o", "h", "l", "y", "b")

# ---- label clean-up of money reports --------------------------------------
LABEL_REPLACEMENTS = (
    ("(元)", ""),
    ("買賣超", "買賣差額"),
    ("大 盤 ", "大盤"),
)
SIDE_LABELS = {
    "買進金額": "buy_money_amount",
    "賣出金額": "sell_money_amount",
}
SIDE_DEFAULT = "diff_money_amount"

# ---- security master: source heading -> column ----------------------------
SECURITY_COLUMNS = {
    "公司代號": "stock_code",
    "公司名稱": "company_name",
    "公司簡稱": "company_name_ch",
    "英文簡稱": "company_name_en",
    "產業類別": "industry",
    "成立日期": "establishment_date",
    "上市日期": "listed_date",
    "實收資本額(元)": "company_capital",
    "已發行普通股數或TDR原發行股數": "outstanding_principal",
    "私募普通股(股)": "private_equity",
    "特別股(股)": "preferred_stock",
    "公司網址": "company_url",
}
SECURITY_LISTED_HEADING = {"TWSE": "上市日期", "OTC": "上櫃日期"}
MARKET_NAMES = {"TWSE": "上市", "OTC": "上櫃"}

# ---- investor flows: source heading -> column -----------------------------
FLOW_COLUMNS = {
    "證券代號": "stock_code",
    "外陸資買進股數(不含外資自營商)": "foreign_investor_buy_amount",
    "外陸資賣出股數(不含外資自營商)": "foreign_investor_sell_amount",
    "外陸資買賣超股數(不含外資自營商)": "foreign_investor_vol_amount",
    "外資自營商買進股數": "foreign_investor_dealer_buy_amount",
    "外資自營商賣出股數": "foreign_investor_dealer_sell_amount",
    "外資自營商買賣超股數": "foreign_investor_dealer_vol_amount",
    "投信買進股數": "investment_trust_buy_amount",
    "投信賣出股數": "investment_trust_sell_amount",
    "投信買賣超股數": "investment_trust_vol_amount",
    "自營商買進股數(自行買賣)": "dealer_buy_amount",
    "自營商賣出股數(自行買賣)": "dealer_sell_amount",
    "自營商買賣超股數(自行買賣)": "dealer_vol_amount",
    "自營商買進股數(避險)": "dealer_hedge_buy_amount",
    "自營商賣出股數(避險)": "dealer_hedge_sell_amount",
    "自營商買賣超股數(避險)": "dealer_hedge_vol_amount",
    "三大法人買賣超股數": "institutional_investors_vol_amount",
}
FLOW_COLUMNS_OTC = {
    "代號": "stock_code",
    "外資及陸資(不含外資自營商)-買進股數": "foreign_investor_buy_amount",
    "外資及陸資(不含外資自營商)-賣出股數": "foreign_investor_sell_amount",
    "外資及陸資(不含外資自營商)-買賣超股數": "foreign_investor_vol_amount",
    "外資自營商-買進股數": "foreign_investor_dealer_buy_amount",
    "外資自營商-賣出股數": "foreign_investor_dealer_sell_amount",
    "外資自營商-買賣超股數": "foreign_investor_dealer_vol_amount",
    "投信-買進股數": "investment_trust_buy_amount",
    "投信-賣出股數": "investment_trust_sell_amount",
    "投信-買賣超股數": "investment_trust_vol_amount",
    "自營商(自行買賣)-買進股數": "dealer_buy_amount",
    "自營商(自行買賣)-賣出股數": "dealer_sell_amount",
    "自營商(自行買賣)-買賣超股數": "dealer_vol_amount",
    "自營商(避險)-買進股數": "dealer_hedge_buy_amount",
    "自營商(避險)-賣出股數": "dealer_hedge_sell_amount",
    "自營商(避險)-買賣超股數": "dealer_hedge_vol_amount",
    "三大法人買賣超股數合計": "institutional_investors_vol_amount",
}
FLOW_HEADINGS = {"TWSE": FLOW_COLUMNS, "OTC": FLOW_COLUMNS_OTC}
FLOW_VOLUMES = (
    "foreign_investor_vol_amount",
    "foreign_investor_dealer_vol_amount",
    "investment_trust_vol_amount",
    "dealer_vol_amount",
    "dealer_hedge_vol_amount",
    "institutional_investors_vol_amount",
)
MONEY_HEADING = "單位名稱"
MONEY_SIDES = {
    "TWSE": ("買進金額", "賣出金額", "買賣差額"),
    "OTC": ("買進金額(元)", "賣出金額(元)", "買賣超(元)"),
}
#: order of the investors in each market's report; None is a subtotal that is not kept
MONEY_ROWS = {
    "TWSE": (
        "dealer",
        "dealer_hedge",
        "investment_trust",
        "foreign_investor",
        "foreign_investor_dealer",
        "buy_sell_diff_total",
    ),
    "OTC": (
        None,
        "foreign_investor",
        "foreign_investor_dealer",
        "investment_trust",
        None,
        "dealer",
        "dealer_hedge",
        "buy_sell_diff_total",
    ),
}
MONEY_INVESTORS = (
    "dealer",
    "dealer_hedge",
    "investment_trust",
    "foreign_investor",
    "foreign_investor_dealer",
    "buy_sell_diff_total",
)

# ---- monthly revenue: source heading -> column ----------------------------
REVENUE_COLUMNS = {
    "公司代號": "stock_code",
    "公司名稱": "company_name_ch",
    "revenue_year_month": "revenue_year_month",
    "上月比較增減(%)": "last_month_revenue_change_ratio",
    "上月營收": "last_month_gross_revenue",
    "去年同月增減(%)": "last_year_revenue_change_ratio",
    "去年當月營收": "last_year_gross_revenue",
    "當月營收": "gross_revenue",
    "前期比較增減(%)": "prophase_revenue_change_ratio",
    "去年累計營收": "last_year_accumulation_revenue",
    "當月累計營收": "accumulation_revenue",
}

# ---- dividends: columns not kept, then names of the rest by position ------
DIVIDEND_DROPPED = (
    "決議（擬議）進度",
    "期別",
    "股利所屬 期間",
    "股東會 日期",
    "期初未分配盈餘/待彌補虧損(元)",
    "可分配 盈餘(元)",
    "本期淨利(淨損)(元)",
    "分配後期末未分配盈餘(元)",
    "摘錄公司章程-股利分派部分",
)
DIVIDEND_NAMES = (
    "stock_code",
    "dividend_year",
    "dividend_date",
    "cash_dividend",
    "capital_reserve_cash_dividend_1",
    "capital_reserve_cash_dividend_2",
    "cash_dividend_total",
    "stock_dividend",
    "capital_reserve_stock_dividend_1",
    "capital_reserve_stock_dividend_2",
    "stock_dividend_total",
    "remarks",
)
DIVIDEND_LAYOUT = (
    "stock_code",
    "dividend_year",
    "dividend_date",
    "cash_dividend",
    "capital_reserve_cash_dividend",
    "cash_dividend_total",
    "stock_dividend",
    "capital_reserve_stock_dividend",
    "stock_dividend_total",
    "remarks",
)

# ---- exchange rates -------------------------------------------------------
FX_COLUMNS = (
    "currency_type",
    "bank_note_buying_rate",
    "bank_note_selling_rate",
    "spot_buying_rate",
    "spot_selling_rate",
)

# ---- industries of the monthly ratio report -------------------------------
INDUSTRIES = (
    "大 盤 ", "水泥工業類", "食品工業類", "塑膠工業類", "紡織纖維類", "電機機械類",
    "電器電纜類", "玻璃陶瓷類", "造紙工業類", "鋼鐵工業類", "橡膠工業類", "汽車工業類",
    "建材營造類", "航運業類", "觀光事業類", "金融保險類", "貿易百貨類", "其他類",
    "化學工業類", "生技醫療類", "油電燃氣類", "半導體類", "電腦及周邊設備類", "光電類",
    "通信網路類", "電子零組件類", "電子通路類", "資訊服務類", "其他電子類",
    "未含金融保險類", "未含電子類", "未含金融電子類", "水泥窯製類", "塑膠化工類",
    "機電類", "化學生技醫療類", "電子工業類",
)
INDUSTRY_RATIO_COLUMNS = {
    "P/E RATIO AND YIELD OF LISTED STOCKS": "stock_industry",
    "Unnamed: 5": "PER",
    "Unnamed: 7": "yield",
    "Unnamed: 9": "PBR",
}

# ---- statement classes and modes ------------------------------------------
STATEMENT_MODES = {
    "0": ("general",),
    "1": ("bank", "securities", "holding", "insurance"),
    "all": ("bank", "securities", "holding", "insurance", "other", "general"),
}

# ---- balance sheet component lists ----------------------------------------
BANK_CURRENT_ASSETS = (
    "現金及約當現金", "存放央行及拆借銀行同業", "透過損益按公允價值衡量之金融資產",
    "透過其他綜合損益按公允價值衡量之金融資產", "按攤銷後成本衡量之債務工具投資",
    "避險之衍生金融資產淨額", "附賣回票券及債券投資淨額", "應收款項－淨額",
    "當期所得稅資產", "待出售資產－淨額", "待分配予業主之資產－淨額", "貼現及放款－淨額",
)
BANK_NON_CURRENT_ASSETS = (
    "採用權益法之投資－淨額", "受限制資產－淨額", "其他金融資產－淨額", "不動產及設備－淨額",
    "使用權資產－淨額", "投資性不動產投資－淨額", "無形資產－淨額", "遞延所得稅資產",
    "其他資產－淨額",
)
BANK_CURRENT_LIABILITIES = (
    "央行及銀行同業存款", "央行及同業融資", "透過損益按公允價值衡量之金融負債",
    "避險之衍生金融負債－淨額", "附買回票券及債券負債", "應付款項", "當期所得稅負債",
    "與待出售資產直接相關之負債", "存款及匯款",
)
BANK_NON_CURRENT_LIABILITIES = (
    "應付金融債券", "應付公司債", "特別股負債", "其他金融負債", "負債準備", "租賃負債",
    "遞延所得稅負債", "其他負債",
)
INSURANCE_CURRENT_ASSETS = (
    "現金及約當現金", "應收款項", "本期所得稅資產", "待出售資產",
    "待分配予業主之資產（或處分群組）",
)
INSURANCE_NON_CURRENT_ASSETS = (
    "投資", "再保險合約資產", "不動產及設備", "使用權資產", "無形資產", "遞延所得稅資產",
    "其他資產", "分離帳戶保險商品資產",
)
INSURANCE_CURRENT_LIABILITIES = (
    "短期債務", "應付款項", "本期所得稅負債", "與待出售資產直接相關之負債",
    "透過損益按公允價值衡量之金融負債", "避險之衍生金融負債", "應付債券", "特別股負債",
    "其他金融負債", "租賃負債", "保險負債",
)
INSURANCE_NON_CURRENT_LIABILITIES = (
    "具金融商品性質之保險契約準備", "外匯價格變動準備", "負債準備", "遞延所得稅負債",
    "其他負債", "分離帳戶保險商品負債",
)

# ---- statement layouts ----------------------------------------------------
INCOME_MEASURES = (
    "gross_revenue",
    "operating_costs",
    "gross_profit",
    "operating_expenses",
    "bad_debt_expense",
    "operating_income",
    "non_operating_income",
    "profit_before_tax",
    "income_tax_expense",
    "profit_after_tax",
    "EPS",
)
BALANCE_COLUMNS = {
    "流動資產": "current_assets",
    "非流動資產": "non_current_assets",
    "資產總計": "total_assets",
    "流動負債": "current_liabilities",
    "非流動負債": "non_current_liabilities",
    "負債總計": "total_liabilities",
    "股本": "capital",
    "庫藏股票": "treasury_stock",
    "非控制權益": "non_controlling_interest",
    "權益總計": "stockholders_equity",
    "每股參考淨值": "PBR",
}
CASH_FLOW_MEASURES = (
    "operating_cash_flows",
    "investing_cash_flows",
    "financing_cash_flows",
    "others_cash_flows",
    "net_cash_flow",
    "free_cash_flow",
    "beginning_balance",
    "ending_balance",
)

# ---- income statement source columns by industry class --------------------
# One entry per measure of INCOME_MEASURES; None = not published for the
# class; two names = their sum.
INCOME_SOURCES = {
    "bank": (
        ("利息淨收益", "利息以外淨損益"), None, None, "營業費用",
        "呆帳費用、承諾及保證責任準備提存", None, None, "繼續營業單位稅前淨利（淨損）",
        "所得稅費用（利益）", "淨利（損）歸屬於母公司業主", "基本每股盈餘（元）",
    ),
    "securities": (
        "收益", None, None, "支出及費用", None, "營業利益", "營業外損益",
        "稅前淨利（淨損）", "所得稅費用（利益）", "淨利（損）歸屬於母公司業主",
        "基本每股盈餘（元）",
    ),
    "holding": (
        ("利息淨收益", "利息以外淨損益"), None, None, "營業費用",
        "呆帳費用、承諾及保證責任準備提存", None, None, "繼續營業單位稅前淨利（淨損）",
        "所得稅費用（利益）", "淨利（損）歸屬於母公司業主", "基本每股盈餘（元）",
    ),
    "insurance": (
        "營業收入", "營業成本", None, "營業費用", None, "營業利益（損失）",
        "營業外收入及支出", "繼續營業單位稅前純益（純損）", "所得稅費用（利益）",
        "本期淨利（淨損）", "基本每股盈餘（元）",
    ),
    "other": (
        "收入", None, None, "支出", None, None, None, "繼續營業單位稅前淨利（淨損）",
        "所得稅費用（利益）", "淨利（淨損）歸屬於母公司業主", "基本每股盈餘（元）",
    ),
    "general": (
        "營業收入", "營業成本", "營業毛利（毛損）淨額", "營業費用", None,
        "營業利益（損失）", "營業外收入及支出", "稅前淨利（淨損）", "所得稅費用（利益）",
        "淨利（淨損）歸屬於母公司業主", "基本每股盈餘（元）",
    ),
}
