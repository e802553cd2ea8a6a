"""Fixed values.

Texts and codes below are part of the file layouts this engine reproduces; they
must stay exactly as they are for results to match.
"""

# Peril codes, in the order of the peril columns of the files.
PERILS = ("FIRE", "HURRICANE", "EARTHQUAKE", "FLOOD", "WIND_HAIL", "TERRORISM", "NBCR")
NO_PERIL = "(none)"

# Separators of the folded lists.
PRODUCT_SEPARATOR = "___"
PERIL_SEPARATOR = ", "

# Construction wording and the number most downstream systems use for it.
CONSTRUCTION_NUMBERS = {
    "UNKNOWN": 0,
    "FRAME": 1,
    "JOISTED MASONRY": 2,
    "NON-COMBUSTIBLE": 3,
    "MASONRY NON-COMBUSTIBLE": 4,
    "MODIFIED FIRE RESISTIVE": 5,
    "FIRE RESISTIVE": 6,
    "SUP MSNRY NON-COMBUSTIBLE": 9,
}
DECODED_SCHEME = "ISO_FIRE"

# Transaction types that count as direct business.
DIRECT_TYPES = ("Direct", "Direct Funded")
# Accounting years of premium looked back on.
PREMIUM_YEARS = 5

# Sublimit areas, first match wins.
WIND_AREA = "AllLoc-Wind"
QUAKE_AREA = "AllLoc-EQ"
FLOOD_AREA = "AllLoc-Flood"

# Location file columns that are always empty, by section of the file.
BUILDERS_RISK_COLUMNS = ("InceptionDate", "ExpirationDate", "ProjectCompletion", "ProjectPhaseCode")
CAMPUS_COLUMNS = ("IsPrimary", "LocationGroup")
MODIFIER_COLUMNS = (
    "CustomFloodSOP", "CustomFloodZone", "FloorOfInterest", "BuildingCondition",
    "BuildingShape", "Torsion", "SoftStory", "ShapeIrregularity", "SpecialConstruction",
    "Retrofit", "ShortColumn", "Ornamentation", "WaterHeater", "Redundancy", "TallOneStory",
    "Equipment", "SealofApproval", "RoofGeometry", "RoofPitch", "RoofCover", "RoofDeck",
    "RoofCoverAttachment", "RoofDeckAttachment", "RoofAnchorage", "RoofAttachedStructure",
    "RoofYearBuilt", "Tank", "RoofHailImpactResistance", "Chimney", "WallType", "WallSiding",
    "GlassType", "GlassPercent", "WindowProtection", "ExternalDoors", "BuildingExteriorOpening",
    "BrickVeneer", "FoundationConnection", "FoundationType", "InternalPartition",
    "TransitionInSRC", "AttachedStructures", "AppurtenantStructures", "Pounding",
    "TreeExposure", "SmallDebris", "LargeMissile", "TerrainRoughness",
    "AdjacentBuildingHeight", "BasementLevelCount", "BasementFinishType", "CustomElevation",
    "CustomElevationUnit", "BaseFloodElevation", "BaseFloodElevationUnit", "FirstFloorHeight",
    "FirstFloorHeightUnit", "ServiceEquipmentProtection", "FIRMCompliance",
    "ContentVulnerability", "Certified Structures (IBHS)", "PPC Code", "Fire Sprinklers",
)
GEOCODE_COLUMNS = ("Latitude", "Longitude", "UserGeocodeMatchLevel")

# Format classes of layer and exposure ids.
FORMAT_SHORT = "7Digit-mod"
FORMAT_LAYERED = "SymPolMod-LayerNumber"
FORMAT_FULL = "Sym+Pol+Mod"
FORMAT_OTHER = "Check these"
