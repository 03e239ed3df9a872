"""Explicit schemas of the nested inputs.

Text fields also accept numbers, booleans and whole objects: the JSON reader then keeps their
JSON text, so a cell that is sometimes an object never breaks a load.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

TEXT, STAMP, FLAG, WHOLE = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.LongType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(names: str) -> dict[str, T.DataType]:
    return {name: TEXT for name in names.split()}


INSTALLER_RESPONSE = struct(
    appointmentStartTime=STAMP, appointmentEndTime=STAMP,
    **texts("equipmentSerialNumber classification representantCpf representantName"),
    evidence=struct(fileUrl=TEXT),
    **texts("technicianId caidEquipamento scidEquipamento latlongInstalacao pta"),
)

SERVICE_ORDER = struct(
    **texts("number status type notation installer failureReason createdBy"),
    registeredAt=STAMP,
    schedules=T.ArrayType(struct(date=STAMP, installer=TEXT)),
    installerResponse=INSTALLER_RESPONSE,
)

SERVICE = struct(
    protocol=struct(number=TEXT, createdAt=STAMP, channel=TEXT),
    serviceOrder=SERVICE_ORDER,
    **texts("tabulation failureReason"),
)

# One document per ticket.
TICKET = struct(
    _id=TEXT, createdAt=STAMP, lastModifiedDate=STAMP, createdBy=TEXT,
    customer=struct(
        **texts("name cpf email"),
        cadUnico=struct(**texts("familyCode nis ibgeCode")),
        address=struct(**texts("streetName number complement neighborhood postalCode city state reference")),
        contacts=T.ArrayType(struct(value=TEXT)),
    ),
    services=T.ArrayType(SERVICE),
)

CAMPAIGN = struct(**texts("phone date campaignName city status origin id"))

CHATBOT_EVENT = struct(
    **texts("id phone date channel category action status protocol trackingBlipEafId identity "
            "updateDate sessionID errors tracking"),
    crm=struct(**texts("uuid ibgeCode familyCode cpf name")),
)

CALL = struct(
    **texts("id hash dataHoraInicio dataHoraFim csv midia"),
    atendimento=T.ArrayType(struct(
        tipo=TEXT, tempoEspera=WHOLE, tempoAtendimento=WHOLE, atendidaAte60Seg=FLAG,
        desistenciaAte60Seg=FLAG, atendidaPos60Seg=FLAG, desistenciaPos60Seg=FLAG)),
    interlocutor=struct(
        origem=TEXT, cadastroLocalizadoEAF=FLAG, **texts("uf ddd codigoCidadeIBGE cpf cep telefone")),
)


def travel_type(name: str) -> T.DataType:
    """Flags are named ``is…``/``has…``; every other travel field is read as text."""
    return FLAG if re.match(r"(is|has)[A-Z]", name) else TEXT
