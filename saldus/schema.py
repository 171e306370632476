"""The customer record: 48 fields, their Spark types and their descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INSTALMENTS = T.StructType([T.StructField("qtd", T.IntegerType()), T.StructField("valor", T.DoubleType())])
EVENT = T.StructType(
    [
        T.StructField("tipo", T.StringType()),
        T.StructField("origem", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("campos_alterados", T.ArrayType(T.StringType())),
        T.StructField("saldo_inicial", T.DoubleType()),
        T.StructField("saldo_anterior", T.DoubleType()),
        T.StructField("saldo_novo", T.DoubleType()),
        T.StructField("saldo_atual", T.DoubleType()),
        T.StructField("diferenca", T.DoubleType()),
        T.StructField("classificacao_saldo", T.StringType()),
        T.StructField("texto", T.StringType()),
    ]
)

STATUS_VALUES = ("sem_debito", "em_aberto", "em_negociacao", "cobranca_enviada", "promessa_pagamento", "pago", "inadimplente_recorrente")
CONSENT_VALUES = ("concedido", "negado", "nao_solicitado")
#: States that a sync may set anew; the others belong to people.
AUTOMATIC_STATUS = ("sem_debito", "em_aberto")
ADDRESS = ("endereco_logradouro", "endereco_numero", "endereco_complemento", "endereco_bairro", "endereco_cidade", "endereco_uf", "endereco_cep")

_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

#: Name, declared type, mandatory, origin, purpose, editable; the Spark type.
FIELDS = (
    ("prime_id", "string(uuid)", True, "PRIME", "Identificador unico e definitivo do cliente no PRIME", False, _S),
    ("nex_codigo", "string|number", True, "NEX", "Referencia externa ao Codigo do cadastro do NEX", False, _S),
    ("origem_sistema", "enum(NEX,Base44,Manual,CSV,API,Outro)", True, "PRIME", "Sistema/processo de origem do registro", False, _S),
    ("nome", "string", True, "NEX", "Identificacao do cliente", True, _S),
    ("cpf_cnpj", "string", False, "NEX", "Documento legal, quando disponivel", True, _S),
    ("telefone", "string", False, "NEX", "Canal secundario", True, _S),
    ("celular", "string", False, "NEX", "Canal principal (WhatsApp)", True, _S),
    ("email", "string", False, "NEX", "Canal alternativo", True, _S),
    ("canal_preferido", "enum(whatsapp,sms,ligacao,email,nenhum)", False, "PRIME/IA", "Canal priorizado pela automacao", True, _S),
    ("whatsapp_validado", "boolean", False, "PRIME", "Confirma se o numero e WhatsApp ativo", True, _B),
    ("endereco_logradouro", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_numero", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_complemento", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_bairro", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_cidade", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_uf", "string", False, "NEX", "Endereco", True, _S),
    ("endereco_cep", "string", False, "NEX", "Endereco", True, _S),
    ("saldo_debito_nex", "decimal", True, "NEX", "Valor de debito da ultima exportacao", False, _D),
    ("saldo_credito_nex", "decimal", True, "NEX", "Valor de credito da ultima exportacao", False, _D),
    ("saldo_debito_anterior", "decimal", False, "PRIME", "saldo_debito_nex da sincronizacao anterior", False, _D),
    ("saldo_credito_anterior", "decimal", False, "PRIME", "saldo_credito_nex da sincronizacao anterior", False, _D),
    ("variacao_saldo", "decimal", False, "Derivado", "Diferenca entre saldo liquido atual e anterior", False, _D),
    ("valor_liquido_nex", "decimal", True, "Derivado", "saldo_debito_nex - saldo_credito_nex", False, _D),
    ("data_snapshot_nex", "timestamp", True, "PRIME", "Data do arquivo que originou o saldo", False, _S),
    ("observacao_original_nex", "string", False, "NEX", "Texto bruto preservado", False, _S),
    ("observacao_categoria", "enum(estruturada,parcialmente_estruturada,texto_operacional,ambigua,vazia)", False, "Derivado", "Classificacao automatica da observacao", False, _S),
    ("vencimento_sugerido", "integer(dia)", False, "Derivado", "Sugestao de vencimento extraida da observacao", True, _I),
    ("parcelamento_sugerido", "object{qtd,valor}", False, "Derivado", "Sugestao de parcelamento extraida da observacao", True, INSTALMENTS),
    ("confianca_extracao", "enum(alta,media,baixa)|null", False, "Derivado", "Confiabilidade da extracao acima", False, _S),
    ("vencimento_confirmado", "date|integer", False, "PRIME", "Vencimento validado por humano", True, _S),
    ("parcelamento_confirmado", "object{qtd,valor}", False, "PRIME", "Parcelamento validado", True, INSTALMENTS),
    ("status_cobranca", "enum(sem_debito,em_aberto,em_negociacao,cobranca_enviada,promessa_pagamento,pago,inadimplente_recorrente)", True, "PRIME", "Estado do processo de cobranca", True, _S),
    ("observacao_prime", "string", False, "PRIME", "Anotacao interna da equipe", True, _S),
    ("historico", "array<object>", True, "PRIME", "Log de eventos do cliente", False, T.ArrayType(EVENT)),
    ("ultima_cobranca_enviada_em", "timestamp", False, "PRIME", "Controle de reenvio", False, _S),
    ("proxima_cobranca_agendada_em", "timestamp", False, "PRIME/IA", "Proxima acao agendada", True, _S),
    ("tentativas_cobranca", "integer", True, "PRIME", "Contador de tentativas", False, _I),
    ("risco_inadimplencia", "decimal|enum", False, "IA", "Score de propensao a nao pagar", False, _D),
    ("resumo_ia", "string", False, "IA", "Resumo textual da situacao", False, _S),
    ("sentimento_ultima_resposta", "enum", False, "IA", "Sentimento da ultima resposta do cliente", False, _S),
    ("consentimento_contato", "enum(concedido,negado,nao_solicitado)", True, "PRIME", "Controle de consentimento para contato", True, _S),
    ("consentimento_registrado_em", "timestamp", False, "PRIME", "Auditoria do consentimento", False, _S),
    ("cadastro_score", "decimal|enum", False, "Derivado", "Avaliacao automatica da qualidade/completude do cadastro (algoritmo ainda nao definido)", False, _D),
    ("criado_em", "timestamp", True, "PRIME", "Data da importacao inicial", False, _S),
    ("atualizado_em", "timestamp", True, "PRIME", "Data da ultima sincronizacao", False, _S),
    ("fonte_arquivo_origem", "string", True, "PRIME", "Nome do arquivo usado na ultima sincronizacao", False, _S),
    ("tipo_ultima_operacao", "enum(importacao_inicial,sincronizacao)", True, "PRIME", "Processo que tocou o registro por ultimo", False, _S),
    ("hash_registro_nex", "string", False, "Derivado", "Hash para deteccao de mudanca na sincronizacao", False, _S),
)

SCHEMA = T.StructType([T.StructField(n, kind, True, {"tipo": t, "obrigatorio": o, "origem": g, "finalidade": f, "editavel": e}) for n, t, o, g, f, e, kind in FIELDS])


def schema_catalog(spark: SparkSession) -> DataFrame:
    """campo, tipo, obrigatorio, origem, finalidade, editavel: a row for each field."""
    return spark.createDataFrame([x[:6] for x in FIELDS], "campo string, tipo string, obrigatorio boolean, origem string, finalidade string, editavel boolean")
