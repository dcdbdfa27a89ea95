"""Column knowledge for the housing price tables: the maps a user of that data needs.

Fixed values: level names, their order and the feature definitions must equal the published data
dictionary for results to be right.
"""

_POOR_TO_EXCELLENT = {"Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
_ABSENT_TO_EXCELLENT = {None: 0, **_POOR_TO_EXCELLENT}
_FINISH = {None: 0, "Unf": 1, "LwQ": 2, "Rec": 3, "BLQ": 4, "ALQ": 5, "GLQ": 6}

RECODE = {
    "MSSubClass": {code: f"SC{code}" for code in (20, 30, 40, 45, 50, 60, 70, 75, 80, 85, 90, 120, 150, 160, 180, 190)},
    "MoSold": dict(enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)),
}

ORDINAL = {
    "Alley": {None: 0, "Grvl": 1, "Pave": 2},
    "BsmtCond": _ABSENT_TO_EXCELLENT,
    "BsmtExposure": {None: 0, "No": 1, "Mn": 2, "Av": 3, "Gd": 4},
    "BsmtFinType1": _FINISH,
    "BsmtFinType2": _FINISH,
    "BsmtQual": _ABSENT_TO_EXCELLENT,
    "ExterCond": _POOR_TO_EXCELLENT,
    "ExterQual": _POOR_TO_EXCELLENT,
    "FireplaceQu": _ABSENT_TO_EXCELLENT,
    "Functional": {"Sal": 1, "Sev": 2, "Maj2": 3, "Maj1": 4, "Mod": 5, "Min2": 6, "Min1": 7, "Typ": 8},
    "GarageCond": _ABSENT_TO_EXCELLENT,
    "GarageQual": _ABSENT_TO_EXCELLENT,
    "HeatingQC": _POOR_TO_EXCELLENT,
    "KitchenQual": _POOR_TO_EXCELLENT,
    "LandSlope": {"Sev": 1, "Mod": 2, "Gtl": 3},
    "LotShape": {"IR3": 1, "IR2": 2, "IR1": 3, "Reg": 4},
    "PavedDrive": {"N": 0, "P": 1, "Y": 2},
    "PoolQC": {None: 0, "Fa": 1, "TA": 2, "Gd": 3, "Ex": 4},
    "Street": {"Grvl": 1, "Pave": 2},
    "Utilities": {"ELO": 1, "NoSeWa": 2, "NoSewr": 3, "AllPub": 4},
    "Fence": {None: 0, "MnWw": 1, "GdWo": 2, "MnPrv": 3, "GdPrv": 4},
}

NUMERIC_ORDINAL = [
    "OverallQual", "OverallCond", "BsmtFullBath", "BsmtHalfBath", "FullBath", "HalfBath",
    "BedroomAbvGr", "KitchenAbvGr", "TotRmsAbvGrd", "Fireplaces", "GarageCars",
]

ABSENT_MEANS_NONE = ["MasVnrType", "GarageType", "GarageFinish"]
NEAR_DUPLICATE = ["GarageCond", "GarageYrBlt"]
DROP = ["MiscFeature"]
NEAR_CONSTANT_SHARE = 0.95

SUMS = {
    "TotalBsmtFin": ["BsmtFinSF1", "BsmtFinSF2"],
    "TotalSF": ["TotalBsmtSF", "1stFlrSF", "2ndFlrSF"],
    "TotalPorch": ["OpenPorchSF", "EnclosedPorch", "ScreenPorch", "3SsnPorch", "WoodDeckSF"],
}
WEIGHTED = {"TotalBath": {"FullBath": 1.0, "HalfBath": 0.5, "BsmtFullBath": 1.0, "BsmtHalfBath": 0.5}}
DIFFERENCES = {"HouseAge": ("YrSold", "YearBuilt"), "RemodAge": ("YrSold", "YearRemodAdd")}

OUTLIER_LIMITS = {"LotFrontage": 200, "LotArea": 100000, "BsmtFinSF1": 4000, "TotalBsmtSF": 5000, "GrLivArea": 4000}
