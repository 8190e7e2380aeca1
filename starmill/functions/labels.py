"""Values that appear in stored rows."""

from datetime import datetime

# Customer types, labels for missing attributes, load states, process names.
PERSON = "PERSONA"
COMPANY = "EMPRESA"

NO_COLOR = "N/A"
NO_SUBCATEGORY = "Sin SubCategoria"
NO_CATEGORY = "Sin Categoria"
NO_NAME = "Sin Nombre"
NO_COUNTRY = "Sin Pais"
NO_GROUP = "Sin Grupo"
NO_JOB = "Sin carga"

UNKNOWN_KEY = -1
UNKNOWN_SALESPERSON = "VENTA POR INTERNET / SIN VENDEDOR"
UNKNOWN_JOB = "N/A"

RUNNING = "EN PROCESO"
OK = "OK"
ERROR = "ERROR"

FIRST_WATERMARK = datetime(1900, 1, 1)

STG_CUSTOMER = "STG_CLIENTE"
STG_PRODUCT = "STG_PRODUCTO"
STG_PROMOTION = "STG_PROMOCION"
STG_SALESPERSON = "STG_VENDEDOR"
STG_TERRITORY = "STG_TERRITORIO"
DW_CUSTOMER = "DW_DIM_CLIENTE"
DW_PRODUCT = "DW_DIM_PRODUCTO"
DW_PROMOTION = "DW_DIM_PROMOCION"
DW_SALESPERSON = "DW_DIM_SALESPERSON"
DW_TERRITORY = "DW_DIM_TERRITORIO"
DW_SALES = "DW_FACT_SALES"
