"""Table columns by name. Types: s text, i int, l long, d amount, f double, D date, T timestamp."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DecimalType(18, 4), "f": T.DoubleType(),
    "D": T.DateType(), "T": T.TimestampType(),
}

# Column names and order of the mart tables.
TABLES = {
    "DimChannel": "ChannelMarge s, Channel s, ChannelDesc s, SalesOffice s, SalesOfficeDesc s, ChannelVSMS s, "
                  "ChannelVSMSDesc s, ETLLoadData T",
    "DimCustGrp1": "CustGrp i, CustGrpDesc s, CustGrpDescription s, ShopType s, ETLLoadData T",
    "DimCustGrpSap": "CustGroup s, CustGroupDesc s, CustGroupDescption s, ETLLoadData T",
    "DimPromotion": "PromotionCode s, PromotionDesc s, ETLLoadData T",
    "DimReason": "ReasonCode s, ReasonName s, ETLLoadData T",
    "DimMaterial": "UseCompany s, Material s, OldMaterial s, MaterialDescThai s, MaterialDescriptionThai s, "
                   "MaterialDescEng s, MaterialDescriptionEng s, MaterialType s, MaterialTypeDesc s, "
                   "MaterialTypeDescription s, Flaver s, FlaverDesc s, FlaverDescription s, PackagingType s, "
                   "Packaging s, PackagingDesc s, PackagingDescription s, NABPackSize s, NABPackSizeDesc s, "
                   "NABPackSizeDescription s, Sizing s, SizingDesc s, SizingDescription s, BasicMaterial s, "
                   "BrandCode s, BrandDesc s, BrandDescription s, GroupPostMix s, CubeUnit s, CubeUnitDesc s, "
                   "CubeUnitDescription s, CubeConvert d, MatType1Id i, MatType1 s, Millilitre d, KPIweight d, "
                   "xCase d, BOM_Case d, BOM_Bottle d, ETLLoadData T",
    "DimMaterialOld": "Material s, MaterialDesc1 s, MaterialDesc2 s, MaterialDesc1Thai s, MaterialDesc2Thai s, "
                      "MatGrp s, MatGrpDesc1 s, MatGrpDesc2 s, MatType1Id i, MatType1 s, MatType2 s, MatType3 s, "
                      "MatType4 s, Brand1 s, Brand2 s, Brand3 s, PackageSize s, PackageQty d, Millilitre d, "
                      "Multiply d, KPIweight d, MaterialGrp1Desc s, MaterialGrp2Desc s, MaterialGrp3Desc s, "
                      "MaterialGrp4Desc s, MaterialGrp5Desc s, BOM_Case d, BOM_Bottle d, ETLLoadData T",
    "DimCustomerOld": "Customer s, CustomerDesc s, CustType s, CustGrp1 i, LONGITUDE s, LATITUDE s, STREET s, "
                      "HOUSE_NUM1 s, HOUSE_NUM2 s, STR_SUPPL3 s, CITY2 s, POST_CODE1 s, CITY1 s, REGIOGROUP s, "
                      "DESCRIPT s, SpecialGrp1 s, SpecialGrp2 s, CustAdj s, Consent s, ConsentDate s, "
                      "BillSubDistrict s, BillDistrict s, BillProvince s, BillZipCode s, WorkSubDistrict s, "
                      "WorkDistrict s, WorkProvince s, WorkZipCode s, TaxNo s, ThaiBevGroup s, ETLLoadData T",
    "DimCustomer": "HANAFlag i, OldCustomer s, Customer s, CustomerDesc s, CustomerDescription s, CustType s, "
                   "Consent s, ConsentDate s, VP s, CustAdj s, CustAdjDesc s, CustAdjDescription s, SpecialGrp1 s, "
                   "SpecialGrp2 s, BillSubDistrict s, BillDistrict s, BillProvince s, BillZipCode s, "
                   "WorkSubDistrict s, WorkDistrict s, WorkProvince s, WorkZipCode s, LONGITUDE f, LATITUDE f, "
                   "PointRegion s, PointProvinceTH s, PointProvinceEN s, PointAmphoeTH s, PointAmphoeEN s, "
                   "PointTambonTH s, PointTambonEN s, CustGrp1 s, CustGroup s, ThaiBevGroup s, TaxNo s, "
                   "FirstBillingDate D, FirstBillingMonth s, FirstBillingYear i, ETLLoadData s",
    "DimLocation": "BranchCode s, League s, Warehouse s, OldBranchCode s, BranchDescThai s, BranchDescriptionThai s, "
                   "BranchDescEng s, BranchDescriptionEng s, PlantCode s, PlantDescThai s, PlantDescriptionThai s, "
                   "PlantDescEng s, PlantDescriptionEng s, CompanyCode s, CompanyDescThai s, "
                   "CompanyDescriptionThai s, CompanyDescEng s, CompanyDescriptionEng s, RegionThaiBev s, "
                   "RegionTBL s, RegionSSC s, SubRegionSSC s, Latitude f, Longitude f, PointRegion s, "
                   "PointProvinceTH s, PointProvinceEN s, PointAmphoeTH s, PointAmphoeEN s, PointTambonTH s, "
                   "PointTambonEN s, PxIncludeFlag i, ETLLoadData T",
    "DimLocationExcel": "League s, BranchCode s, Warehouse s, PxIncludeFlag i, RegionSale_Label s",
    "DimRoute": "Route s, TerritoryDistrict s, SalesType1 s, SalesType2 s, BranchVL s, RegionSSC s, SubBranch l, "
                "RouteDesc s, RouteDescription s, Sector s, ETLLoadData T",
    "DimRouteExcel": "Route s, TerritoryDistrict s, SalesType1 s, SalesType2 s, BranchVL s, RegionSSC s, "
                     "SubBranch l, SalesMan s, TDM s, DM s, YM i",
    "DimSalesman": "Salesman s, SalesmanDesc s, SalesmanDescription s, ETLLoadData T",
    "DimSalesmanExcel": "Salesman s, SalesmanDesc s, SalesmanDescription s",
    "DimBillingDateExcel": "DATE D, IS_WORKDAY i",
    "FactAllDataInvoice": "HANAFlag i, Branch s, YM s, DateKey s, BillingDate T, Route s, Channel s, ChannelVSMS s, "
                          "ChannelMarge s, SalesOffice s, BType s, Salesman s, Customer s, Documents s, Material s, "
                          "SoldCase d, SoldSingle d, SoldBaseQty d, FreeCase d, FreeSingle d, FreeBaseQty d, "
                          "NetItemAmt d, VatAmt d, TotalAmt d, Discount d, SoldTo s, BillTo s, Payer s, ShipTo s, "
                          "DataSource s, PromotionCode s, ReasonCode s, DOCUMENT_NUMBER s, VL s, ETLLoadData T",
    "FactVisitList": "Branch s, Route s, Salesman s, Customer s, AssignedDate D, ETLLoadData T",
    "FactActualVisit": "Branch s, Route s, Salesman s, Customer s, VisitDate D, ETLLoadData T",
    "FactDataAsset": "YM s, BranchByAsset s, BranchByVP s, VPRoute s, Customer s, AssetType s, AssetSubType s, "
                     "AssetStatus s, ActiveStatus s, AssetQRCode s, AssetCode s, AssetDesc s, AssetEquipmentNo s, "
                     "AssetSerialNo s, ETLLoadData T",
    "FactCustPerMonPlan": "YM s, Branch s, Route s, Customer s, CustomerTotal i, FirstActiveBillingDate D, "
                          "FirstBillingMonth s, FirstBillingMonthCount i, SellToCustomer s, ETLLoadData T",
    "FactRouteSalesman": "Route s, BranchVL s, SalesMan s, TDM s, DM s, YM i, ETLLoadData T",
    "FactAOP": "YM s, Branch s, SubBranch s, BranchDesc s, Brand s, ShopType s, AOPLY d, AOP d",
    "FactAOPDM": "YM s, Branch s, SubBranch s, BranchDesc s, Brand s, ShopType s, AOPLY d, AOP d",
    "FactAOPNDDM": "YM s, Branch s, SubBranch s, BranchDesc s, Brand s, ShopType s, AOPLY d, AOP d",
    "FactAOPRoute": "YM s, Route s, Brand s, ShopType s, AOPLYRoute d, AOPRoute d",
    "FactAOPNDRoute": "YM s, Route s, Brand s, ShopType s, AOPLYRoute d, AOPRoute d",
    "FactAOPTDM": "TDMName s, TDMID s, ShopType s, YM s, Brand s, TargetType s, LY d, AOP d",
    "FactAOPNDTDM": "TDMName s, TDMID s, ShopType s, YM s, Brand s, TargetType s, LY d, AOP d",
    "TargetSheet": "TDMName s, TDMID s, ShopType s, StartDate s, Brand s, TargetType s, LY s, AOP s",
    "AggInvByBrandYM": "HANAFlag i, DateKey s, BranchCode s, RouteCode s, Salesman s, ChannelSalesOffice s, "
                       "CustomerCode s, DataSource s, BillType s, BrandDescription s, Brand s, NoOfBrandBill l, "
                       "NoOfBrandBillCN l, SoldSingle d, SoldCase d, SoldBaseQty d, SoldLitre d, FreeCase d, "
                       "FreeBaseQty d, FreeLitre d, NetItemAmt d, VatAmt d, TotalAmount d, Discount d",
}


def columns(table: str) -> list[str]:
    return [item.split()[0] for item in TABLES[table].split(",")]


def schema(table: str, text_only: bool = False) -> T.StructType:
    """Declared schema; ``text_only`` reads every cell as text, for landings."""
    pairs = [item.split() for item in TABLES[table].split(",")]
    return T.StructType([T.StructField(name, T.StringType() if text_only else _TYPES[kind]) for name, kind in pairs])
